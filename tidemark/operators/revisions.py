"""Revision catalog: classify listed assets, describe them, group them.

Assets stay one per row. The list form (a map of arrays on the revision row) is
built only for revisions below a stated number of files, because a single
revision may own any share of all assets.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import revision_prefix
from tidemark.operators.sizing import broadcast_if_small, chunked_lists, numbered, short_lists
from tidemark.schemas import DATASET_NAME, KEYS, MANIFEST_PREFIX
from tidemark.session import scratch

#: Revisions with more data files than this keep only the tall form.
LIST_ROWS = 512


def is_manifest(name: Column, prefix: str = MANIFEST_PREFIX) -> Column:
    return name.startswith(prefix)


def asset_descriptor(bucket: Column | str, key: Column) -> Column:
    """``struct(bucket, key, version)`` with a null version."""
    bucket = F.lit(bucket) if isinstance(bucket, str) else bucket
    return F.struct(
        bucket.alias("bucket"),
        key.alias("key"),
        F.lit(None).cast("string").alias("version"),
    )


def data_assets(
    listing: DataFrame,
    bucket: str,
    prefix: str | None = None,
    at: Column | None = None,
    dataset_name: str = DATASET_NAME,
    manifest_prefix: str = MANIFEST_PREFIX,
    also: Sequence[str] = (),
) -> DataFrame:
    """Listed assets that are data, one row each, with bucket, key and version.

    The key is the listed one when the listing has it, otherwise it is composed as
    ``prefix/Y/M/D/H/dataset/revision/name``.
    """
    if "key" in listing.columns:
        key = F.col("key")
    else:
        key = F.concat(revision_prefix(prefix, at, F.col("dataset_id"), F.col("revision_id")), F.col("name"))
    return listing.where(~is_manifest(F.col("name"), manifest_prefix)).select(
        *KEYS,
        F.lit(dataset_name).alias("dataset_name"),
        "pos",
        "name",
        asset_descriptor(bucket, key).alias("asset"),
        *also,
    )


def revision_headers(listing: DataFrame, manifest_prefix: str = MANIFEST_PREFIX) -> DataFrame:
    """One row per revision: last manifest in listing order, number of data files.

    Both are constant-size aggregates, combined per map task before the shuffle.
    """
    manifest = is_manifest(F.col("name"), manifest_prefix)
    return listing.groupBy(*KEYS).agg(
        F.max_by(F.when(manifest, F.col("name")), F.when(manifest, F.struct("pos", "name"))).alias("metadata"),
        F.count_if(~manifest).alias("n_data_files"),
    )


def pack_data_files(assets: DataFrame, max_rows: int = LIST_ROWS) -> DataFrame:
    """``map<dataset_name, list of assets in listing order>`` per revision.

    A revision is packed whole or not at all: over ``max_rows`` the map is NULL. The few that
    are so long are counted first, so that their assets are neither sorted nor moved.
    """
    counts = assets.where(F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()).groupBy(*KEYS)
    long = counts.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(*KEYS)
    lists = short_lists(
        assets.join(broadcast_if_small(long), KEYS, "left_anti"),
        KEYS,
        ["pos", "name"],
        F.struct("dataset_name", "asset"),
        max_rows,
        "_items",
    )
    names = F.array_distinct(F.transform("_items", lambda i: i["dataset_name"]))
    grouped = F.transform(
        names,
        lambda n: F.struct(
            n.alias("key"),
            F.transform(
                F.filter("_items", lambda i: i["dataset_name"] == n), lambda i: i["asset"]
            ).alias("value"),
        ),
    )
    packed = lists.select(*KEYS, F.map_from_entries(grouped).alias("data_files"))
    kind = packed.schema["data_files"].dataType
    return packed.unionByName(long.withColumn("data_files", F.lit(None).cast(kind)))


def asset_chunks(assets: DataFrame, rows: int = 1000, path: str | None = None) -> DataFrame:
    """(keys, chunk, assets): all assets of every revision in listing order, however many."""
    return chunked_lists(assets, KEYS, ["pos", "name"], F.struct("pos", "name", "asset"), rows, "assets", path)


def build_revisions(
    listing: DataFrame,
    bucket: str,
    prefix: str | None = None,
    at: Column | None = None,
    max_rows: int = LIST_ROWS,
    manifest_prefix: str = MANIFEST_PREFIX,
) -> DataFrame:
    """Listing to revision rows: headers plus the map form where it is short enough.

    A revision without data files has an empty map, as one without manifest has a
    NULL ``metadata``.
    """
    assets = data_assets(listing, bucket, prefix, at, manifest_prefix=manifest_prefix)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array())
    packed = pack_data_files(assets, max_rows)
    joined = revision_headers(listing, manifest_prefix).join(packed, KEYS, "left")
    kind = packed.schema["data_files"].dataType
    return joined.withColumn(
        "data_files",
        F.when(F.col("n_data_files") == 0, empty.cast(kind)).otherwise(F.col("data_files")),
    )


def explode_assets(revisions: DataFrame, dataset_name: str = DATASET_NAME, files: str = "data_files") -> DataFrame:
    """One row per asset of a map entry; a revision without the entry gives none."""
    keep = [c for c in revisions.columns if c != files]
    return revisions.select(
        *keep, F.posexplode(F.try_element_at(files, F.lit(dataset_name))).alias("pos", "asset")
    )


def every_asset(
    revisions: DataFrame, assets: DataFrame, dataset_name: str = DATASET_NAME, files: str = "data_files"
) -> DataFrame:
    """``explode_assets`` of every revision, however many files it has.

    ``assets`` are the tall rows (see ``data_assets``). They serve the revisions whose map is
    NULL because their list was too long for one row; all others come from their map. The
    revisions are written once, since they are read four times.
    """
    path = scratch(revisions.sparkSession, "revisions")
    revisions.write.parquet(path)
    revisions = revisions.sparkSession.read.schema(revisions.schema).parquet(path)
    keep = [c for c in revisions.columns if c != files]
    short = explode_assets(revisions.where(F.col(files).isNotNull()), dataset_name, files)
    long = revisions.where(F.col(files).isNull() & (F.col("n_data_files") > 0)).select(*keep)
    tall = assets.where(F.col("dataset_name") == dataset_name).select(*KEYS, F.col("pos").alias("_pos"), "name", "asset")
    # the long revisions are the small side, whatever share of the files is theirs
    chosen = tall.join(broadcast_if_small(long.select(*KEYS)), KEYS, "left_semi")
    placed = numbered(chosen, KEYS, ["_pos", "name"]).select(*KEYS, F.col("place").cast("int").alias("pos"), "asset")
    return short.unionByName(placed.join(broadcast_if_small(long), KEYS).select(*keep, "pos", "asset"))


def without_assets(revisions: DataFrame, dataset_name: str = DATASET_NAME, files: str = "data_files") -> DataFrame:
    """Revisions with no assets under the entry: the reject output of ``explode_assets``.

    A NULL map of a revision that counts data files stands for a list too long for one
    row (its assets come with ``every_asset``), not for none.
    """
    entry = F.try_element_at(files, F.lit(dataset_name))
    if "n_data_files" in revisions.columns:
        return revisions.where(
            F.when(F.col(files).isNull(), F.coalesce(F.col("n_data_files"), F.lit(0)) == 0).otherwise(
                F.coalesce(F.size(entry) <= 0, F.lit(True))
            )
        )
    return revisions.where(F.coalesce(F.size(entry) <= 0, F.lit(True)))


def rekey_assets(assets: Column, when: Column | None, new_key) -> Column:
    """An asset array with ``key`` replaced by ``new_key(asset)`` where ``when(asset)``."""

    def rekeyed(asset: Column) -> Column:
        changed = asset.withField("key", new_key(asset))
        return changed if when is None else F.when(when(asset), changed).otherwise(asset)

    return F.transform(assets, rekeyed)


def clashing_names(assets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Output names that more than one asset of a revision would take."""
    return assets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_assets")).where("n_assets > 1")
