"""CSV output: plain append, partitioned, and with the asset's own name."""

from collections import deque
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.text import parent
from tidemark.sources.assets import list_files, path_segment

#: Quotes inside a quoted field are doubled, as CSV readers expect.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def _without_blank_lines(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """A NULL alone in its row would be a blank line, which the CSV writer leaves out;
    as an empty text the row is written (``""``) and read again."""
    fields = [f for f in df.schema.fields if f.name not in partition_by]
    if len(fields) != 1 or not isinstance(fields[0].dataType, StringType):
        return df
    return df.fillna("", subset=[fields[0].name])


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    max_records_per_file: int | None = None,
) -> None:
    """CSV with a header row.

    By default every task writes what it holds, so no row moves and no key is too
    hot. ``single_file`` gathers everything into one task; it is for small output.
    """
    df = _without_blank_lines(df, partition_by)
    writer = (df.coalesce(1) if single_file else df).write.mode(mode).options(**CSV_OPTIONS)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def written_folders(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """One row per written partition folder: its values, key, part count, first part."""
    depth = len(by) + 1
    parts = list_files(spark, path, "part-*").withColumn("folder", parent(F.col("key")))
    values = [path_segment(F.col("key"), i - depth).alias(c) for i, c in enumerate(by)]
    return (
        parts.select("folder", "key", *values)
        .groupBy(*by, "folder")
        .agg(F.count(F.lit(1)).alias("n_parts"), F.min("key").alias("first_part"))
    )


def _place(spark: SparkSession, source: str | None, target: str, header: str) -> None:
    """Move one file or folder to its final name, replacing what a replay left there.

    Without a source the asset gave no rows and gets a file holding the header only.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    dst = path(target)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, True)
    if source is None:
        out = fs.create(dst, True)
        out.write(bytearray(f"{header}\n", "utf-8"))
        out.close()
    elif not fs.rename(path(source), dst):
        raise OSError(f"could not rename {source} to {target}")


def name_folders(
    spark: SparkSession,
    staging: str,
    root: str,
    names: DataFrame,
    by: Sequence[str],
    header: str,
    threads: int = 16,
) -> None:
    """Move each written partition folder to its ``target`` key below ``root``.

    ``names`` holds one row per partition value of ``by``. A folder with one part
    becomes a file of that name; one with several parts becomes a folder of that
    name, which reads the same. Only names pass through the driver, streamed one
    partition at a time; the data stays where Spark wrote it.
    """
    moves = names.join(written_folders(spark, staging, by), list(by), "left").select(
        F.when(F.col("n_parts") == 1, F.col("first_part")).otherwise(F.col("folder")).alias("source"),
        "target",
    )

    def place(row) -> None:
        source = None if row["source"] is None else f"{staging}/{row['source']}"
        _place(spark, source, f"{root}/{row['target']}", header)

    with ThreadPoolExecutor(threads) as pool:
        running = deque()
        for row in moves.toLocalIterator():
            running.append(pool.submit(place, row))
            if len(running) >= threads * 8:
                running.popleft().result()
        for task in running:
            task.result()


def write_named_csv(
    df: DataFrame,
    staging: str,
    root: str,
    names: DataFrame,
    by: Sequence[str],
) -> None:
    """One CSV per value of ``by``, stored under the ``target`` given in ``names``.

    Two values with the same target would overwrite each other and raise.
    """
    clash = names.groupBy("target").count().where("count > 1").first()
    if clash is not None:
        raise ValueError(f"more than one output is named {clash['target']}")
    write_csv(df, staging, "overwrite", by)
    header = ",".join(c for c in df.columns if c not in by)
    name_folders(df.sparkSession, staging, root, names, by, header)
