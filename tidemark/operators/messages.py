"""Outbound messages: one per revision, or one per converted asset."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import json_text
from tidemark.operators.sizing import short_lists
from tidemark.schemas import DATASET_NAME, KEYS, MESSAGE_LIMIT_BYTES


def fewest_asset_bytes() -> int:
    """Size of an asset descriptor with empty texts: no asset adds less to a message."""
    return len(json.dumps({"bucket": "", "key": "", "version": None}, separators=(",", ":")))


def rows_that_may_fit(limit_bytes: int) -> int:
    """More assets than this cannot fit into ``limit_bytes``, whatever their keys."""
    return limit_bytes // fewest_asset_bytes()


def message_text(data_files: Column) -> Column:
    return json_text(F.struct(F.col("dataset_id"), F.col("revision_id"), data_files.alias("dataFilesMap")))


def fits(message: Column, limit_bytes: int = MESSAGE_LIMIT_BYTES) -> Column:
    return F.octet_length(message) <= limit_bytes


def split_oversize(
    messages: DataFrame, limit_bytes: int = MESSAGE_LIMIT_BYTES, message: str = "message"
) -> tuple[DataFrame, DataFrame]:
    """(sendable, rejected). A NULL message is one already known not to fit."""
    sendable = F.coalesce(fits(F.col(message), limit_bytes), F.lit(False))
    return messages.where(sendable), messages.where(~sendable)


def _as_map(items: Column, key) -> Column:
    """``{"heartbeat": [asset, ...]}`` with each asset's key chosen by ``key(item)``."""
    assets = F.transform(items, lambda i: i["asset"].withField("key", key(i)))
    return F.create_map(F.lit(DATASET_NAME), assets)


def outbound_messages(
    assets: DataFrame,
    mode: str = "revision",
    limit_bytes: int = MESSAGE_LIMIT_BYTES,
) -> DataFrame:
    """Message rows from asset rows (keys, ``pos``, ``name``, ``asset``, ``csv_key``).

    ``revision``: one message per revision, every key converted. ``progress``: one
    per asset, holding the converted key for that asset and those before it and the
    original key for the rest; ``pos`` and ``name`` give its place.

    ``message`` is NULL when the revision has so many assets that no message about
    it can fit the limit: such lists are never gathered. Every revision (or asset)
    has its row, so ``split_oversize`` loses nothing.
    """
    item = F.struct("pos", "name", "asset", "csv_key")
    lists = short_lists(assets, KEYS, ["pos", "name"], item, rows_that_may_fit(limit_bytes), "_items")
    if mode == "revision":
        text = message_text(_as_map(F.col("_items"), lambda i: i["csv_key"]))
        return lists.select(
            *KEYS,
            F.lit(None).cast("long").alias("pos"),
            F.lit(None).cast("string").alias("name"),
            F.when(F.col("_items").isNotNull(), text).alias("message"),
        )
    if mode != "progress":
        raise ValueError(f"unknown mode: {mode}")
    at = assets.select(*KEYS, F.struct("pos", "name").alias("_at"))
    long = lists.where(F.col("_items").isNull()).select(*KEYS)
    # groups that may fit are short, so only they are joined with their lists; the rows
    # of long ones pass by, whichever group holds most of them
    rows = at.join(lists.where(F.col("_items").isNotNull()), KEYS)
    passed = at.join(long, KEYS, "left_semi").withColumn("message", F.lit(None).cast("string"))

    def key_so_far(i: Column) -> Column:
        # a missing place counts as the first, as it does in the order of messages
        done = F.coalesce(i["pos"], F.lit(-1)) < F.coalesce(F.col("_at.pos"), F.lit(-1))
        same = i["pos"].eqNullSafe(F.col("_at.pos")) & (i["name"] <= F.col("_at.name"))
        return F.when(done | same, i["csv_key"]).otherwise(i["asset"]["key"])

    told = rows.withColumn("message", message_text(_as_map(F.col("_items"), key_so_far)))
    return told.drop("_items").unionByName(passed).select(
        *KEYS, F.col("_at.pos").cast("long").alias("pos"), F.col("_at.name").alias("name"), "message"
    )
