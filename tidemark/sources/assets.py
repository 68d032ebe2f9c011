"""Asset listings and the one scan that reads every listed file."""

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import base_name, decoded_path, parent, path_only
from tidemark.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from tidemark.schemas import HEARTBEAT
from tidemark.sources.json_lines import read_json_lines

#: Most folder names a listing or scan hands to Spark one by one.
MAX_FOLDERS = 5000

#: Levels above the assets' own folders that a narrowed scan may climb.
MAX_LEVELS = 8


def relative_key(path: Column, root: str) -> Column:
    """Object key of a Spark-reported path below ``root``, free of scheme and host."""
    below = path_only(F.lit(root.rstrip("/")))
    return F.substr(path_only(path), F.length(below) + 2)


def path_segment(path: Column, index: int) -> Column:
    """Path segment counted from the end; of ``column=value`` the unescaped value.

    NULL where the path has no such segment.
    """
    plain = F.try_element_at(F.split(path, "/"), F.lit(index))
    value = F.regexp_extract(plain, r"^[A-Za-z_]\w*=(.*)$", 1)
    return F.when(value != "", decoded_path(value)).otherwise(plain)


def list_files(spark: SparkSession, root: str, pattern: str = "*", folders: Sequence[str] | None = None) -> DataFrame:
    """(key, file_path, bytes, modified_at) of the files below ``root``, or below
    ``folders`` of it.

    Only metadata is read: without its ``content`` column the ``binaryFile`` source
    opens no file. ``file_path`` is the text every other Spark scan of the same file
    reports, ``key`` the readable name below ``root``. Spark lists no empty files:
    they hold no records.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(list(folders) if folders else root)
        .select(
            relative_key(F.col("path"), root).alias("key"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def list_assets(
    spark: SparkSession, root: str, pattern: str = "*", folders: Sequence[str] | None = None
) -> DataFrame:
    """Files below ``root`` laid out as ``.../dataset/revision/name``.

    ``pos`` is NULL: names are unique within a folder and order its listing.
    """
    key = F.col("key")
    return list_files(spark, root, pattern, folders).select(
        path_segment(key, -3).alias("dataset_id"),
        path_segment(key, -2).alias("revision_id"),
        F.lit(None).cast("long").alias("pos"),
        base_name(key).alias("name"),
        "key",
        "file_path",
        "bytes",
        "modified_at",
    )


def _plain(names: Sequence[str]) -> bool:
    """No name would be read as a pattern."""
    return not any(c in name for name in names for c in "*?[]{}\\")


def _nameable(folder: str) -> str:
    """The folder, or the deepest one above it whose path no reader takes for a pattern."""
    while not _plain([folder]):
        folder = folder.rpartition("/")[0]
    return folder


def escaped(path: str) -> str:
    """A path whose signs stand for themselves where patterns are allowed."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def existing_folders(spark: SparkSession, folders: Sequence[str], threads: int = 16) -> list[str]:
    """Folders a path or pattern stands for; those that are not there are left out."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def match(folder: str) -> list[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return [s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []]

    with ThreadPoolExecutor(threads) as pool:
        return [found for matches in pool.map(match, folders) for found in matches]


def _few(df: DataFrame, limit: int) -> list[dict] | None:
    """Distinct rows of ``df`` if there are at most ``limit``; one more is fetched to know."""
    rows = df.distinct().limit(limit + 1).collect()
    return [row.asDict() for row in rows] if len(rows) <= limit else None


def fixed_prefix(layout: str) -> str:
    """Leading folders of a layout that name no variable part."""
    fixed = []
    for segment in layout.split("/"):
        if "*" in segment or "{" in segment:
            break
        fixed.append(segment)
    return "/".join(fixed)


def nameable_files(files: DataFrame, most: int = MAX_FOLDERS) -> list[str] | None:
    """Paths of ``files``, as readers take them, if they are few and none would be read as a pattern."""
    rows = _few(files.select(decoded_path(F.col("file_path")).alias("file_path")), most)
    paths = [row["file_path"] for row in rows or []]
    return paths if rows is not None and _plain(paths) else None


def list_requested(requested: DataFrame, root: str, layout: str, max_folders: int = MAX_FOLDERS) -> DataFrame:
    """Listing of the requested (dataset_id, revision_id), at the cost of those alone.

    ``layout`` says where a revision's folder is below ``root``, such as
    ``in/*/*/*/*/{dataset_id}/{revision_id}``. Up to ``max_folders`` requests are
    looked up by folder; more by the folders of their data sets, then by listing the
    layout's fixed prefix. All give the same rows. ``file_index`` answers without look-ups.
    """
    spark = requested.sparkSession
    keys = ["dataset_id", "revision_id"]
    above = layout.split("{revision_id}")[0].rpartition("/")[0]
    folders = None
    for columns, pattern in ((keys, layout), (keys[:1], above)):
        names = _few(requested.select(*columns), max_folders)
        if names is not None:
            told = [{c: escaped(v) for c, v in row.items()} for row in names]
            folders = existing_folders(spark, [f"{root.rstrip('/')}/{pattern.format(**row)}" for row in told])
            folders = sorted({_nameable(f) for f in folders})
            break
    else:
        # more than can be named: what the layout fixes, never other folders below the root
        fixed = fixed_prefix(layout)
        folders = existing_folders(spark, [f"{root.rstrip('/')}/{fixed}" if fixed else root])
    if not folders:
        return list_assets(spark, root).limit(0)
    wanted = broadcast_if_small(requested.select(*keys).distinct())
    return list_assets(spark, root, folders=folders).join(wanted, keys, "left_semi")


def scan_folders(
    assets: DataFrame, root: str, max_folders: int = MAX_FOLDERS, inputs: str = ""
) -> list[str] | None:
    """Folders below ``root`` that together hold the assets, or None for all of it.

    When they are too many to name, ``inputs`` is the folder that holds all assets.

    The deepest level with at most ``max_folders`` folders is taken: the assets' own,
    else those one level up, and so on. The folders only narrow what is listed and
    opened; which files count is decided by a join.
    """
    folder = parent(F.col("key"))
    whole = [f"{root.rstrip('/')}/{inputs}"] if inputs else None
    for level in range(MAX_LEVELS):
        names = _few(assets.select(folder.alias("f")), max_folders)
        found = [row["f"] for row in names or []]
        if "" in found:
            return whole
        if found and _plain(found):
            return [f"{root.rstrip('/')}/{name}" for name in found]
        folder = F.when(folder.contains("/"), parent(folder)).otherwise("")
    return whole


def common_folder(assets: DataFrame, root: str) -> list[str] | None:
    """The deepest folder below ``root`` that holds all assets, or None for ``root`` itself.

    What the least and the greatest key begin with, all keys in between begin with: two
    values pass through the driver, however many assets there are.
    """
    ends = assets.agg(F.min("key").alias("least"), F.max("key").alias("greatest")).first()
    if ends["least"] is None:
        return None
    shared = commonprefix([ends["least"], ends["greatest"]]).rpartition("/")[0]
    shared = _nameable(shared)
    return [f"{root.rstrip('/')}/{shared}"] if shared else None


def locate_assets(assets: DataFrame, root: str, folders: Sequence[str] | None = None) -> DataFrame:
    """``assets`` with the ``file_path`` and ``bytes`` of the file under their ``key``.

    Both are NULL when there is no such file or it is empty.
    """
    files = list_files(assets.sparkSession, root, folders=folders).select("key", "file_path", "bytes")
    return assets.join(files, "key", "left")


def scan_assets(
    assets: DataFrame,
    root: str,
    schema: T.StructType = HEARTBEAT,
    broadcast_bytes: int = BROADCAST_BYTES,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of every listed file, beside the columns of its asset row.

    One scan serves all assets. Each row's own file path is joined as it is to the
    asset's ``file_path`` (see ``locate_assets``), so no text is worked on per row;
    the asset side is broadcast when its measured size allows, and then the rows do
    not move. Give a listing or a written table: it is measured, then joined.
    """
    rows = read_json_lines(assets.sparkSession, list(folders or [root]), schema, recursive=True)
    rows = rows.withColumn("file_path", F.col("_metadata.file_path"))
    return rows.join(broadcast_if_small(assets, broadcast_bytes), "file_path")
