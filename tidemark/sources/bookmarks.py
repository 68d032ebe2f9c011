"""Batch runs that read a file once: a committed ledger of path, size and time.

A run takes the files that no earlier run has committed in their present form, so a changed
file is read again and an unchanged one is not. Its list is written under the run's number
before anything is read; a run that is repeated reads the same list again, and ``commit``
marks it as done once its output stands. Files of a run that never committed come with the
next one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.snapshots import numbered_folders
from tidemark.schemas import HEARTBEAT
from tidemark.sources.assets import MAX_FOLDERS, common_folder, list_files, nameable_files, scan_assets, scan_folders
from tidemark.sources.json_lines import read_json_lines

LEDGER = "key STRING, file_path STRING, bytes BIGINT, modified_at TIMESTAMP"


def _read(spark: SparkSession, path: str, runs: list[int]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*[f"{path}/run={n}" for n in runs])


def new_files(spark: SparkSession, root: str, ledger: str, run: int, pattern: str = "*") -> DataFrame:
    """Files of this run, listed and written once; a repeated run finds its own list."""
    listed = f"{ledger}/listed"
    if run not in numbered_folders(spark, listed, "run", committed=True):
        done = set(numbered_folders(spark, f"{ledger}/committed", "run"))
        earlier = [n for n in numbered_folders(spark, listed, "run", committed=True) if n < run and n in done]
        known = _read(spark, listed, earlier).select("key", "bytes", "modified_at")
        found = list_files(spark, root, pattern).join(known, ["key", "bytes", "modified_at"], "left_anti")
        found.select("key", "file_path", "bytes", "modified_at").write.mode("overwrite").parquet(f"{listed}/run={run}")
    return _read(spark, listed, [run])


def bookmarked_scan(
    spark: SparkSession, root: str, ledger: str, run: int, schema: T.StructType = HEARTBEAT, pattern: str = "*"
) -> DataFrame:
    """Lines of the files of this run, with their ``key``.

    Few files are opened by name; of many, the folders that hold them, and a join on the
    file's path leaves out the rest.
    """
    files = new_files(spark, root, ledger, run, pattern)
    named = nameable_files(files, MAX_FOLDERS)
    if named is not None and not named:
        empty = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        return spark.createDataFrame([], empty).withColumn("key", F.lit(None).cast("string"))
    folders = named or scan_folders(files, root) or common_folder(files, root)
    if named is None:
        return scan_assets(files.select("key", "file_path"), root, schema, folders=folders).drop("file_path")
    rows = read_json_lines(spark, named, schema).withColumn("file_path", F.col("_metadata.file_path"))
    return rows.join(F.broadcast(files.select("key", "file_path")), "file_path").drop("file_path")


def commit(spark: SparkSession, ledger: str, run: int) -> None:
    """The run's output stands: later runs leave out its files."""
    spark.range(1).select(F.lit(run).alias("done")).write.mode("overwrite").parquet(f"{ledger}/committed/run={run}")
