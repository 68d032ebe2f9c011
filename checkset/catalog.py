"""Revision catalog: classify, describe, group, explode, rename."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.functions.text import base_name, file_stem, hour_prefix, json_text, stem
from tidemark.operators.revisions import (
    asset_descriptor,
    build_revisions,
    clashing_names,
    data_assets,
    explode_assets,
    rekey_assets,
    revision_headers,
    without_assets,
)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the listed files of their order; returned ones are manifests."""
    kind = F.when(F.col("l_returnflag") == "R", "manifest-").otherwise("file-")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("dataset_id"),
        F.col("l_orderkey").cast("string").alias("revision_id"),
        F.col("l_linenumber").cast("long").alias("pos"),
        F.concat(kind, F.col("l_partkey"), F.lit("."), F.col("l_suppkey"), F.lit(".json")).alias("name"),
    )


LISTING_SQL = """SELECT l_linestatus AS dataset_id, CAST(l_orderkey AS VARCHAR) AS revision_id,
       CAST(l_linenumber AS BIGINT) AS pos,
       CASE WHEN l_returnflag = 'R' THEN 'manifest-' ELSE 'file-' END
       || l_partkey || '.' || l_suppkey || '.json' AS name FROM lineitem"""


@query(
    """SELECT p_brand AS revision_id,
              arg_max(p_name, p_partkey) FILTER (WHERE starts_with(p_name, 'red')) AS metadata,
              count(*) FILTER (WHERE NOT starts_with(p_name, 'red')) AS n_data_files
       FROM part GROUP BY p_brand"""
)
def revision_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last manifest and number of data files per revision; few keys, all rows."""
    parts = table(spark, sf_dir, "part").select(
        F.lit("parts").alias("dataset_id"),
        F.col("p_brand").alias("revision_id"),
        F.col("p_partkey").alias("pos"),
        F.col("p_name").alias("name"),
    )
    return revision_headers(parts, manifest_prefix="red").drop("dataset_id")


@query(
    f"""WITH listed AS ({LISTING_SQL})
        SELECT dataset_id, revision_id, pos, name,
               'in/2024/1/2/3/' || dataset_id || '/' || revision_id || '/' || name AS key,
               CAST(json_object('bucket', 'b', 'key',
                    'in/2024/1/2/3/' || dataset_id || '/' || revision_id || '/' || name,
                    'version', NULL) AS VARCHAR) AS asset
        FROM listed WHERE NOT starts_with(name, 'manifest')"""
)
def asset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files with their composed key and descriptor (null version kept)."""
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    rows = data_assets(listing(spark, sf_dir), "b", "in", at)
    return rows.select(
        "dataset_id", "revision_id", "pos", "name", F.col("asset.key"), json_text(F.col("asset")).alias("asset")
    )


@query(
    f"""WITH listed AS ({LISTING_SQL}),
        grouped AS (
          SELECT dataset_id, revision_id,
                 max_by(name, (pos, name)) FILTER (WHERE starts_with(name, 'manifest')) AS metadata,
                 count(*) FILTER (WHERE NOT starts_with(name, 'manifest')) AS n_data_files,
                 string_agg('{{"bucket":"b","key":"in/2024/1/2/3/' || dataset_id || '/' || revision_id
                            || '/' || name || '","version":null}}', ',' ORDER BY pos, name)
                   FILTER (WHERE NOT starts_with(name, 'manifest')) AS files
          FROM listed GROUP BY 1, 2)
        SELECT dataset_id, revision_id, metadata, n_data_files,
               CASE WHEN files IS NULL THEN '{{}}' ELSE '{{"heartbeat":[' || files || ']}}' END AS data_files
        FROM grouped"""
)
def revision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole catalog: headers and the map of ordered asset lists."""
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    revisions = build_revisions(listing(spark, sf_dir), "b", "in", at)
    return revisions.withColumn("data_files", json_text(F.col("data_files")))


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a two-file map; pending ones hold theirs under another name."""
    key = F.col("o_orderkey").cast("string")
    files = F.array(
        asset_descriptor("b", F.concat(key, F.lit("/"), "o_orderstatus")),
        asset_descriptor("b", F.concat(key, F.lit("/"), "o_orderpriority")),
    )
    name = F.when(F.col("o_orderstatus") == "P", "other").otherwise("heartbeat")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.create_map(name, files).alias("data_files"))


@query(
    """SELECT o_orderkey, 0 AS pos, o_orderkey || '/' || o_orderstatus AS key FROM orders
       WHERE o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, 1, o_orderkey || '/' || o_orderpriority FROM orders
       WHERE o_orderstatus <> 'P'"""
)
def exploded_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per asset of the map entry."""
    return explode_assets(order_files(spark, sf_dir)).select("o_orderkey", "pos", "asset.key")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def revisions_without_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions whose map has no such entry."""
    return without_assets(order_files(spark, sf_dir)).select("o_orderkey")


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN o_orderkey || '/' || o_orderstatus
                ELSE 'csv/' || o_orderkey || '/' || o_orderstatus END
              || '|' || o_orderkey || '/' || o_orderpriority AS keys
       FROM orders"""
)
def rekeyed_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of some elements of the list replaced in place."""
    files = F.col("data_files")[F.when(F.col("data_files")["other"].isNull(), "heartbeat").otherwise("other")]
    changed = rekey_assets(
        files,
        lambda a: a["key"].rlike("/[FO]$"),
        lambda a: F.concat(F.lit("csv/"), a["key"]),
    )
    return order_files(spark, sf_dir).select(
        "o_orderkey", F.array_join(F.transform(changed, lambda a: a["key"]), "|").alias("keys")
    )


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_assets FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1"""
)
def name_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output names taken more than once within a revision."""
    return clashing_names(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT event_id, 'out/' || year(ts) || '/' || month(ts) || '/' || day(ts) || '/' || hour(ts) || '/'
              AS prefix FROM events"""
)
def output_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour folder with unpadded numbers."""
    return table(spark, sf_dir, "events").select("event_id", hour_prefix("out", F.col("ts")).alias("prefix"))


@query(
    """SELECT page_id, string_split(url, '/')[-1] AS base,
              string_split(string_split(url, '/')[-1], '.')[1] AS stem,
              regexp_replace(string_split(url, '/')[-1], '^(.+)\\.[^.]*$', '\\1') AS file_stem
       FROM pages"""
)
def path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base name, part before the first dot, name without its last extension."""
    base = base_name(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", base.alias("base"), stem(base).alias("stem"), file_stem(base).alias("file_stem")
    )
