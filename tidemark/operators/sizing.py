"""Size-checked choices: what may be broadcast, what may be gathered in a list."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch

BROADCAST_BYTES = 128 * 1024 * 1024

#: What one task sorts at most, by rows and by bytes of the files they come from.
TASK_ROWS = 250_000
TASK_BYTES = 16 * 1024 * 1024


def text_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size: its JSON text plus a fixed row overhead."""
    return F.octet_length(F.to_json(F.struct(*df.columns))) + 64


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring it.

    Beyond the limit it is returned without a hint: the join then shuffles both
    sides and adaptive execution splits skewed keys. The measurement is one
    aggregate over ``df``, so give it a written table, not a long lineage.
    """
    measured = df.agg(F.sum(text_bytes(df)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if measured <= limit_bytes else df


def tasks_for(n_rows: int, file_bytes: int) -> int:
    """How many tasks rows read from files are dealt out to, so that none grows with the input.

    Spark sizes its tasks by compressed bytes: of narrow rows, which compress well, such a task
    sorts millions.
    """
    return max(1, -(-n_rows // TASK_ROWS), -(-file_bytes // TASK_BYTES))


def short_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    max_rows: int,
    name: str = "items",
) -> DataFrame:
    """Ordered list per key for groups of at most ``max_rows`` rows.

    A longer group yields a row with a NULL list, so the caller sees it and uses
    the tall rows (or ``chunked_lists``) instead. Where Spark limits groups on the
    map side (see ``_limited``), a group holding a third of the input sends at most
    ``max_rows + 1`` rows per map task; other limits count first and gather only
    groups that are short enough. Both give the same rows.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    rows = df.select(*keys, *[c for c in order if c not in keys], value.alias("_value"))
    limited = _limited if max_rows + 1 <= threshold else _counted
    return limited(rows, keys, order, max_rows, name)


def _limited(rows: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, name: str) -> DataFrame:
    """By a row-number limit, which Spark applies before the shuffle as well as after it."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rn", F.row_number().over(window))
        .where(F.col("_rn") <= max_rows + 1)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.array_sort(F.collect_list(F.struct("_rn", "_value"))).alias("_rows"),
        )
        .select(
            *keys,
            F.when(F.col("_n") <= max_rows, F.transform("_rows", lambda r: r["_value"])).alias(name),
        )
    )


def _counted(rows: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, name: str) -> DataFrame:
    """By counting: rows of longer groups are left out before the gathering shuffle."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    short = rows.join(counts.where(F.col("_n") <= max_rows).select(*keys), list(keys), "left_semi")
    at = F.struct(*[c for c in order if c not in keys], "_value")
    lists = short.groupBy(*keys).agg(F.array_sort(F.collect_list(at)).alias("_rows"))
    listed = F.transform("_rows", lambda r: r["_value"])
    return counts.join(lists, list(keys), "left").select(*keys, listed.alias(name))


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str | None = None, name: str = "place"
) -> DataFrame:
    """``df`` with each row's place, from 0 and without gaps, along ``order`` within its keys.

    Range partitioning on (keys, order) spreads a long group over many tasks. The sorted ranges
    are written (to ``path``) with their number and each row's place in them first, so a stage
    that is run again finds the same ones; then the rows of a key in earlier ranges are added up,
    a number for each range and key, and a row's place is that sum plus its place among the key's
    rows of its range. The rows are shuffled and sorted once, and no task holds a group. Keys must not be NULL; rows of equal order are told apart by their other columns.
    """
    spark = df.sparkSession
    path = path or scratch(spark, "ranges")
    by = [*keys, *order, "_tie"]
    ranged = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(*by).sortWithinPartitions(*by)
    # the number of the range in the high bits, the row's place in the range in the low ones
    ranged.withColumn("_at", F.monotonically_increasing_id()).drop("_tie").write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.join(starts, [*keys, "_part"])
    return placed.select(*df.columns, (F.col("_start") + F.col("_at") - F.col("_first")).alias(name))


def chunked_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    rows: int = 1000,
    name: str = "items",
    path: str | None = None,
) -> DataFrame:
    """(keys, chunk, list): every group's values in order, in lists of ``rows``, the last one shorter.

    Chunks are numbered from 0 without gaps (see ``numbered``); no task holds a group.
    """
    kept = df.select(*keys, *[c for c in order if c not in keys], value.alias("_value"))
    placed = numbered(kept, keys, order, path, "_place")
    chunk = F.floor(F.col("_place") / rows).alias("chunk")
    lists = placed.groupBy(*keys, chunk).agg(
        F.array_sort(F.collect_list(F.struct("_place", "_value"))).alias("_rows")
    )
    return lists.select(*keys, "chunk", F.transform("_rows", lambda r: r["_value"]).alias(name))
