"""Names for partitioned CSV without a rename: a published manifest that readers resolve.

The CSV stays where Spark wrote it. The manifest is a table with one row per written part:
the output's name (``target``), the values of its partition, the part's key, bytes and rows.
It grows by batches and is written last, so a target that appears in it is complete, and one
that is published again is read from its newest batch alone. No name passes through the
driver.

Partition values are texts. NULL and the empty text are one value, as they are in Spark's
folders. A target without rows has one entry without a part. Two partitions with one target
in a batch raise before anything is written. ``multi_line`` says that texts may hold line
ends; each part is then read by one task, otherwise a long part is split.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizing import broadcast_if_small
from tidemark.operators.snapshots import numbered_folders
from tidemark.sinks.csv import CSV_OPTIONS, write_csv
from tidemark.sources.assets import list_files, nameable_files, path_segment

#: What Spark names the folder of a NULL or empty partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

PARTS = "target STRING, place STRING, key STRING, bytes BIGINT, n_rows BIGINT, batch INT"


def _kind(by: Sequence[str]) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.StringType()) for c in by], *T.StructType.fromDDL(PARTS).fields])


def _counted(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """(file_path, n_rows) of the parts below ``path``, out of the files themselves.

    What is published is what can be read. Each task counts its parts: a part costs a row.
    """
    rows = (
        spark.read.schema("held STRING")
        .options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), recursiveFileLookup="true")
        .option("pathGlobFilter", "part-*")
        .csv(path)
    )
    return rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n_rows"))


def written_parts(
    spark: SparkSession, root: str, place: str, by: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """One row per part below ``root/place``: partition values, key below ``root``, bytes, rows."""
    depth = len(by) + 1
    listed = list_files(spark, f"{root}/{place}", "part-*")
    counted = _counted(spark, f"{root}/{place}", multi_line)
    values = []
    for i, c in enumerate(by):
        value = path_segment(F.col("key"), i - depth)
        values.append(F.when(value != NO_VALUE, value).alias(c))
    parts = listed.join(counted, "file_path", "left")
    return parts.select(
        *values,
        F.concat(F.lit(f"{place}/"), "key").alias("key"),
        "bytes",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def publish(
    spark: SparkSession,
    root: str,
    place: str,
    names: DataFrame,
    by: Sequence[str],
    manifest: str,
    batch: int,
    multi_line: bool = True,
) -> DataFrame:
    """Enter the parts below ``root/place`` under the ``target`` that ``names`` gives each partition.

    A replay overwrites its own batch. Returns the batch's entries, read back.
    """
    parts = written_parts(spark, root, place, by, multi_line)
    same = None
    named, held = names.select(*by, "target").alias("n"), parts.alias("p")
    for c in by:
        equal = F.nullif(F.col(f"n.{c}").cast("string"), F.lit("")).eqNullSafe(F.col(f"p.{c}"))
        same = equal if same is None else same & equal
    rows = named.join(held, same, "left").select(
        *[F.col(f"n.{c}").cast("string").alias(c) for c in by],
        "target",
        F.lit(place).alias("place"),
        "key",
        "bytes",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
    rows.write.mode("overwrite").parquet(f"{manifest}/batch={batch}")
    return read_manifest(spark, manifest, by, [batch])


def write_manifest_csv(
    df: DataFrame,
    root: str,
    place: str,
    names: DataFrame,
    by: Sequence[str],
    manifest: str,
    batch: int,
    multi_line: bool = True,
) -> DataFrame:
    """One CSV output per value of ``by``, found under its ``target`` through the manifest.

    ``place`` is the batch's own folder below ``root``.
    """
    clash = names.groupBy("target").count().where("count > 1").first()
    if clash is not None:
        raise ValueError(f"more than one output is named {clash['target']}")
    write_csv(df, f"{root}/{place}", "overwrite", by)
    return publish(df.sparkSession, root, place, names, by, manifest, batch, multi_line)


def read_manifest(
    spark: SparkSession, manifest: str, by: Sequence[str], batches: Sequence[int] | None = None
) -> DataFrame:
    """Every entry of the batches given, or of all that were fully written."""
    if batches is None:
        batches = numbered_folders(spark, manifest, "batch", committed=True)
    if not batches:
        return spark.createDataFrame([], _kind(by))
    paths = [f"{manifest}/batch={n}" for n in batches]
    return spark.read.schema(_kind(by)).option("basePath", manifest).parquet(*paths)


def live_parts(spark: SparkSession, manifest: str, by: Sequence[str], until: int | None = None) -> DataFrame:
    """Entries of each target's newest batch, at most ``until``: what the target holds now.

    The newest batch per target is a small aggregate; the parts of one target are never
    gathered.
    """
    batches = numbered_folders(spark, manifest, "batch", committed=True)
    entries = read_manifest(spark, manifest, by, [n for n in batches if until is None or n <= until])
    newest = entries.groupBy("target").agg(F.max("batch").alias("batch"))
    return entries.join(newest, ["target", "batch"])


def outputs(parts: DataFrame) -> DataFrame:
    """(target, n_parts, bytes, n_rows): one row per output, also for one without rows."""
    return parts.groupBy("target").agg(
        F.count("key").alias("n_parts"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.sum("n_rows").alias("n_rows"),
    )


def read_outputs(
    spark: SparkSession, parts: DataFrame, root: str, schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """Rows of the outputs whose ``parts`` are given, each beside its ``target``.

    One scan: of the parts themselves while they are few, else of the batches' own folders,
    joined by file as it is. ``parts`` is read more than once: give a table or a short plan.
    The names of the batches' folders pass through the driver, those of outputs do not.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    held = parts.where("key IS NOT NULL").select("target", "key", "place")
    places = [f"{root}/{r['place']}" for r in held.select("place").distinct().collect()]
    empty = T.StructType([*kind.fields, T.StructField("target", T.StringType())])
    if not places:
        return spark.createDataFrame([], empty)
    # the paths as every scan of the same files reports them
    files = list_files(spark, root, "part-*", places).select("key", "file_path")
    found = held.select("target", "key").join(files, "key").select("target", "file_path")
    paths = nameable_files(found) or places
    rows = (
        spark.read.schema(kind)
        .options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), recursiveFileLookup="true")
        .option("pathGlobFilter", "part-*")
        .csv(paths)
    )
    rows = rows.withColumn("file_path", F.col("_metadata.file_path"))
    return rows.join(broadcast_if_small(found), "file_path").select(*kind.fieldNames(), "target")
