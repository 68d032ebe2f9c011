"""De-duplication by an exact span: a copy goes if it comes within the span after the last accepted one.

Rows of equal group and body are taken in time order; the first is accepted, and each later
one if its time is at least the span after that of the last accepted. Which rows stay depends
on all before them, so rows are dealt out by (group, hash of the body), sorted by time and
streamed through the tasks: a task holds one time stamp, however many copies there are. A row
that comes at least the span after its predecessor is accepted whatever came before.

Accepted times go to a ledger under the batch's number, a row for each (group, body); a later
batch starts from the newest of earlier ones, and repeating a batch repeats its result.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import content_hash
from tidemark.operators.latest import latest_by
from tidemark.operators.snapshots import numbered_folders


def micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def accepted_flags(rows: DataFrame, keys: Sequence[str], span_micros: int) -> DataFrame:
    """``rows`` with ``accepted``; needs columns ``_at`` (microseconds) and ``_seed``.

    A seed is an earlier batch's last accepted time; it comes first among its key's rows.
    """
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("_seed").desc(), "_at", *_rest(rows, keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, 0
        for batch in batches:
            flags = []
            for key, at, seed in zip(
                zip(*(batch.column(k).to_pylist() for k in keys), strict=True),
                batch.column("_at").to_pylist(),
                batch.column("_seed").to_pylist(),
                strict=True,
            ):
                new = key != held or (not seed and at >= last + span_micros)
                if new:
                    held, last = key, at
                flags.append(new)
            yield batch.append_column("accepted", pa.array(flags, pa.bool_()))

    return ordered.mapInArrow(run, ordered.withColumn("accepted", F.lit(True)).schema)


def _rest(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    """What orders rows of equal time: all their other columns."""
    return [F.xxhash64(*[c for c in rows.columns if c not in (*keys, "_at", "_seed")])]


def dedup_within_span(
    events: DataFrame,
    group: Sequence[str],
    body: str,
    ts: str,
    span_micros: int,
    ledger: str | None = None,
    batch: int = 0,
) -> DataFrame:
    """Rows of ``events`` that are no copy of one accepted less than the span before.

    Rows without a time or body are kept. With ``ledger`` earlier batches' accepted rows
    count too, and this batch's are noted there.
    """
    spark = events.sparkSession
    keys = [*group, "_hash"]
    sure = F.col(ts).isNotNull() & F.col(body).isNotNull()
    for c in group:
        sure = sure & F.col(c).isNotNull()
    passed = events.where(~F.coalesce(sure, F.lit(False)))
    rows = events.where(sure).select(
        "*", content_hash(F.col(body).cast("string")).alias("_hash"), micros(F.col(ts)).alias("_at"), F.lit(False).alias("_seed")
    )
    if ledger is not None:
        rows = rows.unionByName(_seeds(spark, ledger, keys, batch), allowMissingColumns=True)
    flagged = accepted_flags(rows, keys, span_micros)
    if ledger is not None:
        place = f"{ledger}/flagged/batch={batch}"
        flagged.write.mode("overwrite").parquet(place)
        flagged = spark.read.schema(flagged.schema).parquet(place)
        newest = flagged.where("accepted").groupBy(*keys).agg(F.max("_at").alias("_at"))
        newest.write.mode("overwrite").parquet(f"{ledger}/accepted/batch={batch}")
    kept = flagged.where("accepted AND NOT _seed").select(*events.columns)
    return kept.unionByName(passed)


def _seeds(spark: SparkSession, ledger: str, keys: Sequence[str], batch: int) -> DataFrame:
    """Last accepted time of every key over the batches before ``batch``."""
    path = f"{ledger}/accepted"
    batches = [n for n in numbered_folders(spark, path, "batch") if n < batch]
    kind = ", ".join(f"{k} STRING" for k in keys) + ", _at BIGINT, batch INT"
    if not batches:
        return spark.createDataFrame([], kind).select(*keys, "_at", F.lit(True).alias("_seed"))
    rows = spark.read.schema(kind).option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches])
    return latest_by(rows, keys, ["batch"]).select(*keys, "_at", F.lit(True).alias("_seed"))
