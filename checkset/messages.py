"""Outbound messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.functions.text import json_text
from tidemark.operators.messages import fits, outbound_messages, split_oversize
from tidemark.operators.revisions import asset_descriptor
from tidemark.session import scratch
from tidemark.sinks.messages import write_messages


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the files of their part: some revisions fit a message, some not."""
    name = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.lit("parts").alias("dataset_id"),
        F.col("l_partkey").cast("string").alias("revision_id"),
        F.col("l_orderkey").alias("pos"),
        name.alias("name"),
        asset_descriptor("b", F.concat(F.lit("in/"), name, F.lit(".json"))).alias("asset"),
        F.concat(F.lit("csv/"), name, F.lit(".csv")).alias("csv_key"),
    )


@query(
    """WITH files AS (
         SELECT CAST(l_partkey AS VARCHAR) AS revision_id, l_orderkey AS pos,
                l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS name FROM lineitem),
       texts AS (
         SELECT revision_id, '{"dataset_id":"parts","revision_id":"' || revision_id
                || '","dataFilesMap":{"heartbeat":['
                || string_agg('{"bucket":"b","key":"csv/' || name || '.csv","version":null}', ','
                              ORDER BY pos, name) || ']}}' AS message
         FROM files GROUP BY 1)
       SELECT revision_id, octet_length(encode(message)) <= 2048 AS sent,
              CASE WHEN octet_length(encode(message)) <= 2048 THEN message END AS message
       FROM texts"""
)
def revision_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per revision; those over the size limit keep their row without text."""
    sent = F.coalesce(fits(F.col("message")), F.lit(False))
    return outbound_messages(part_files(spark, sf_dir)).select(
        "revision_id", sent.alias("sent"), F.when(sent, F.col("message")).alias("message")
    )


@query("SELECT doc_id, octet_length(encode(text)) <= 2048 AS sent FROM documents")
def split_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that can be sent and rows that cannot, as two outputs."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    sent, rejected = split_oversize(documents, message="text")
    return sent.select("doc_id", F.lit(True).alias("sent")).unionByName(
        rejected.select("doc_id", F.lit(False).alias("sent"))
    )


@query(
    """WITH files AS (
         SELECT CAST(o_custkey AS VARCHAR) AS revision_id, o_orderkey AS pos, CAST(o_orderkey AS VARCHAR) AS name
         FROM orders),
       texts AS (
         SELECT a.revision_id, a.pos, '{"dataset_id":"orders","revision_id":"' || a.revision_id
                || '","dataFilesMap":{"heartbeat":['
                || string_agg('{"bucket":"b","key":"' || CASE WHEN b.pos <= a.pos THEN 'csv/' || b.name || '.csv'
                              ELSE b.name || '.json' END || '","version":null}', ',' ORDER BY b.pos)
                || ']}}' AS message
         FROM files a JOIN files b USING (revision_id) GROUP BY 1, 2)
       SELECT revision_id, pos, CASE WHEN octet_length(encode(message)) <= 600 THEN message END AS message
       FROM texts"""
)
def progress_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per converted asset: done assets show their new key, others the old."""
    name = F.col("o_orderkey").cast("string")
    files = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("dataset_id"),
        F.col("o_custkey").cast("string").alias("revision_id"),
        F.col("o_orderkey").alias("pos"),
        name.alias("name"),
        asset_descriptor("b", F.concat(name, F.lit(".json"))).alias("asset"),
        F.concat(F.lit("csv/"), name, F.lit(".csv")).alias("csv_key"),
    )
    messages = outbound_messages(files, mode="progress", limit_bytes=600)
    return messages.select(
        "revision_id", "pos", F.when(fits(F.col("message"), 600), F.col("message")).alias("message")
    )


@query(
    """SELECT event_id, CAST(json_object('dataset_id', user_id, 'version', NULL, 'revision_id', event_id)
              AS VARCHAR) AS message FROM events"""
)
def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text that keeps nulls."""
    fields = F.struct(
        F.col("user_id").alias("dataset_id"),
        F.lit(None).cast("string").alias("version"),
        F.col("event_id").alias("revision_id"),
    )
    return table(spark, sf_dir, "events").select("event_id", json_text(fields).alias("message"))


@query("SELECT doc_id, octet_length(encode(text)) <= 2048 AS fits FROM documents")
def message_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size limit in bytes, not characters."""
    return table(spark, sf_dir, "documents").select("doc_id", fits(F.col("text")).alias("fits"))


@query(
    """SELECT user_id, event_id, props AS message,
              row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events"""
)
def message_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written in order within their group; read back, the place of each
    message in its group is its place in the files."""
    path = scratch(spark, "messages")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("props").alias("message"))
    write_messages(events, path, "user_id", ["event_id"])
    back = spark.read.schema("user_id BIGINT, event_id BIGINT, message STRING").json(path)
    placed = back.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    return place_in_group(placed, "user_id").select("user_id", "event_id", "message", "nth")


def place_in_group(placed: DataFrame, group: str) -> DataFrame:
    """Rank of each row in its group by file place.

    Ranks are taken within one file, then shifted by what the group has in earlier
    files; a group spans many files only when it is hot, so no task ranks all of it.
    """
    from pyspark.sql import Window

    inner = Window.partitionBy(group, "file").orderBy("at")
    counts = placed.groupBy(group, "file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(group, "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = placed.withColumn("r", F.row_number().over(inner))
    return ranked.join(shifts, [group, "file"]).withColumn("nth", F.col("r") + F.col("shift"))
