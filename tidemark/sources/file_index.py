"""A table of the input files, so that a request for a revision is a join, not a look-up.

The index grows by batches: one distributed listing of the layout's fixed prefix, less the
files it already holds with the same size and time. Files outside the prefix, such as
earlier outputs below the same root, are never looked at, and ids are compared as texts, so
signs that a path pattern would interpret mean nothing.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import decoded_path
from tidemark.operators.latest import latest_by
from tidemark.operators.sizing import broadcast_if_small
from tidemark.operators.snapshots import numbered_folders
from tidemark.schemas import KEYS
from tidemark.sources.assets import existing_folders, fixed_prefix, list_files

FILES = (
    "dataset_id STRING, revision_id STRING, name STRING, key STRING, file_path STRING, bytes BIGINT,"
    " modified_at TIMESTAMP, batch INT"
)


def layout_pattern(layout: str) -> str:
    """A regular expression over keys: the ids, then the rest as the file's name.

    ``*`` stands for any one folder; ``{dataset_id}`` and ``{revision_id}`` for a folder, or
    for the value in ``column=value``.
    """
    pattern = re.escape(layout).replace(r"\*", "[^/]*")
    for column in KEYS:
        pattern = pattern.replace(re.escape("{" + column + "}"), f"(?<{column.replace('_', '')}>[^/]+)")
    return f"^{pattern}/(?<name>.+)$"


def _part(key: Column, layout: str, column: str) -> Column:
    """One id out of a key; an escaped ``column=value`` is read back."""
    order = sorted(KEYS, key=lambda c: layout.index("{" + c + "}"))
    found = F.regexp_extract(key, layout_pattern(layout), order.index(column) + 1)
    return decoded_path(found) if "={" + column + "}" in layout else found


def list_layout(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """Every file below the layout's prefix that fits the layout, with its ids."""
    prefix = fixed_prefix(layout)
    top = f"{root.rstrip('/')}/{prefix}" if prefix else root
    if not existing_folders(spark, [top]):
        return spark.createDataFrame([], FILES).drop("batch")
    files = list_files(spark, top)
    if prefix:
        files = files.withColumn("key", F.concat(F.lit(f"{prefix}/"), "key"))
    fits = F.col("key").rlike(layout_pattern(layout))
    return files.where(fits).select(
        *[_part(F.col("key"), layout, c).alias(c) for c in KEYS],
        F.regexp_extract("key", layout_pattern(layout), 3).alias("name"),
        "key",
        "file_path",
        "bytes",
        "modified_at",
    )


def read_index(spark: SparkSession, index: str, before: int | None = None) -> DataFrame:
    """Newest entry of every key, from all batches or those before one."""
    batches = [n for n in numbered_folders(spark, index, "batch") if before is None or n < before]
    if not batches:
        return spark.createDataFrame([], FILES)
    rows = spark.read.schema(FILES).option("basePath", index).parquet(*[f"{index}/batch={n}" for n in batches])
    return latest_by(rows, ["key"], ["batch"])


def grow_index(spark: SparkSession, root: str, layout: str, index: str, batch: int) -> None:
    """Add the files that are new or have changed since earlier batches; a replay rewrites its own part."""
    known = read_index(spark, index, batch).select("key", "bytes", "modified_at")
    new = list_layout(spark, root, layout).join(known, ["key", "bytes", "modified_at"], "left_anti")
    new.select("dataset_id", "revision_id", "name", "key", "file_path", "bytes", "modified_at").write.mode(
        "overwrite"
    ).parquet(f"{index}/batch={batch}")


def indexed_listing(requested: DataFrame, index: str, until: int | None = None) -> DataFrame:
    """Files of the requested (dataset_id, revision_id), as a listing with ``file_path`` and ``bytes``."""
    files = read_index(requested.sparkSession, index, None if until is None else until + 1)
    wanted = broadcast_if_small(requested.select(*KEYS).distinct())
    return files.join(wanted, KEYS, "left_semi").select(
        *KEYS, F.lit(None).cast("long").alias("pos"), "name", "key", "file_path", "bytes", "modified_at"
    )
