"""Sources and sinks: each query writes derived files, then reads them back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checkset import query, table
from tidemark.functions.text import array_text, decoded_path, time_text
from tidemark.operators.mapping import apply_mapping, apply_variant_mapping
from tidemark.operators.revisions import is_manifest
from tidemark.schemas import CORRUPT, KEYS, MAPPED_FIELD
from tidemark.session import scratch
from tidemark.sinks.csv import CSV_OPTIONS, write_csv, write_named_csv
from tidemark.sinks.manifest import live_parts, outputs, read_outputs, write_manifest_csv
from tidemark.sources import bookmarks
from tidemark.sources.assets import list_assets, relative_key, scan_assets
from tidemark.sources.json_lines import read_json_lines, read_variant_lines


def write_data_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Events as JSON-lines data files, a folder per (event type, day).

    Rebalancing splits a folder that holds too much and merges small ones, so
    neither a hot type nor many quiet days shape the files.
    """
    events = table(spark, sf_dir, "events")
    values = F.array(time_text(F.col("ts")), F.col("event_type"), F.get_json_object("props", "$.k"))
    lines = events.select(
        F.col("event_type").alias("dataset_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("revision_id"),
        F.to_json(F.struct(values.alias(MAPPED_FIELD))).alias("value"),
    )
    lines.hint("rebalance", *KEYS).write.partitionBy(*KEYS).text(root)


@query(
    """SELECT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id,
              '["' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","' || event_type || '","'
              || json_extract_string(props, '$.k') || '"]' AS timestampssincelastrevision
       FROM events"""
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data files of all revisions: one scan, file-to-asset join, mapping."""
    root = scratch(spark, "files")
    write_data_files(spark, sf_dir, root)
    listing = list_assets(spark, root)
    assets = listing.where(~is_manifest(F.col("name"))).select(*KEYS, "file_path")
    return apply_mapping(scan_assets(assets, root), keep=KEYS)


@query(
    """SELECT DISTINCT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id, true AS has_bytes
       FROM events"""
)
def asset_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata-only listing of the data files, summed up per revision."""
    root = scratch(spark, "files")
    write_data_files(spark, sf_dir, root)
    return list_assets(spark, root).groupBy(*KEYS).agg((F.sum("bytes") > 0).alias("has_bytes"))


EVENT_LINE = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with an explicit schema; unlisted fields are dropped."""
    path = scratch(spark, "json")
    table(spark, sf_dir, "events").withColumn("ts", time_text(F.col("ts"))).write.json(path)
    schema = T.StructType.fromDDL(EVENT_LINE)
    return read_json_lines(spark, path, schema, keep_corrupt=False)


@query(
    """SELECT CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE event_id END AS event_id,
              CASE event_type WHEN 'error' THEN 'broken ' || event_id
                              WHEN 'click' THEN '{"event_id":"x' || event_id || '"}' END AS bad
       FROM events"""
)
def json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines and lines of the wrong type keep their text beside good ones."""
    path = scratch(spark, "json")
    broken = F.concat(F.lit("broken "), F.col("event_id"))
    wrong = F.to_json(F.struct(F.concat(F.lit("x"), F.col("event_id")).alias("event_id")))
    good = F.to_json(F.struct("event_id"))
    line = F.when(F.col("event_type") == "error", broken).when(F.col("event_type") == "click", wrong)
    table(spark, sf_dir, "events").select(line.otherwise(good).alias("value")).write.text(path)
    lines = read_json_lines(spark, path, T.StructType.fromDDL("event_id BIGINT"))
    return lines.select("event_id", F.col(CORRUPT).alias("bad"))


@query(
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'BIGINT' ELSE 'STRING' END AS kind,
              CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE event_type END AS held
       FROM events"""
)
def json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is a number on some lines and text on others, read as Variant."""
    path = scratch(spark, "json")
    clicks = F.col("event_type") == "click"
    number = F.to_json(F.struct("event_id", F.col("user_id").alias("held")))
    text = F.to_json(F.struct("event_id", F.col("event_type").alias("held")))
    table(spark, sf_dir, "events").select(F.when(clicks, number).otherwise(text).alias("value")).write.text(path)
    lines = read_variant_lines(spark, path)
    return lines.select(
        F.variant_get("v", "$.event_id", "bigint").alias("event_id"),
        F.schema_of_variant(F.variant_get("v", "$.held", "variant")).alias("kind"),
        F.variant_get("v", "$.held", "string").alias("held"),
    )


@query("SELECT user_id, event_type, value FROM events")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with header, appended in two parts, read back."""
    path = scratch(spark, "csv")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    write_csv(events.where("event_type = 'click'"), path)
    write_csv(events.where("event_type <> 'click'"), path)
    return spark.read.schema("user_id BIGINT, event_type STRING, value DOUBLE").options(**CSV_OPTIONS).csv(path)


@query("SELECT doc_id, text FROM documents")
def csv_mapped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as arrays of lines, mapped to one text column, through CSV and back."""
    path = scratch(spark, "csv")
    documents = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    write_csv(apply_mapping(documents, [("lines", "array", "lines", "string")], keep=["doc_id"]), path)
    back = spark.read.schema("doc_id BIGINT, lines STRING").options(**CSV_OPTIONS).csv(path)
    return back.select("doc_id", F.array_join(F.from_json("lines", "array<string>"), "\n").alias("text"))


@query(
    """SELECT 'csv/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '.csv' AS file, count(*) AS n_rows
       FROM events GROUP BY 1"""
)
def csv_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV per (event type, day) under a name of our choice."""
    root = scratch(spark, "named")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    by = ["event_type", "day"]
    target = F.concat(F.lit("csv/"), "event_type", F.lit("/"), "day", F.lit(".csv"))
    names = events.select(*by).distinct().withColumn("target", target)
    write_named_csv(events.hint("rebalance", *by), scratch(spark, "staging"), root, names, by)
    written = (
        spark.read.schema("event_id BIGINT")
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .csv(root)
        .select("event_id", relative_key(decoded_path(F.col("_metadata.file_path")), root).alias("file"))
    )
    return written.groupBy(F.regexp_replace("file", "/part-[^/]*$", "").alias("file")).agg(
        F.count("event_id").alias("n_rows")
    )


@query(
    """SELECT event_id, 'csv/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '.csv' AS file,
              count(*) OVER (PARTITION BY event_type, strftime(ts, '%Y-%m-%d')) AS n_rows FROM events"""
)
def csv_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events read back by output name through the manifest; clicks were published wrongly first."""
    root, manifest = scratch(spark, "root"), scratch(spark, "manifest")
    by = ["event_type", "day"]
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    target = F.concat(F.lit("csv/"), "event_type", F.lit("/"), "day", F.lit(".csv"))
    names = events.select(*by).distinct().withColumn("target", target)
    clicks = F.col("event_type") == "click"
    wrong = events.withColumn("event_id", F.when(clicks, -F.col("event_id")).otherwise(F.col("event_id")))
    for batch, rows, chosen in ((0, wrong, names), (1, events.where(clicks), names.where(clicks))):
        rows = rows.hint("rebalance", *by)
        write_manifest_csv(rows, root, f"out/batch={batch}", chosen, by, manifest, batch, multi_line=False)
    parts = live_parts(spark, manifest, by)
    told = outputs(parts).select(F.col("target").alias("file"), "n_rows")
    back = read_outputs(spark, parts, root, "event_id BIGINT", multi_line=False)
    return back.withColumnRenamed("target", "file").join(told, "file")


ORDER_ROW = """'[' || l_orderkey || ',' || l_partkey || ',' || l_suppkey || ']'"""


@query(f"SELECT l_linenumber, {ORDER_ROW} AS ids FROM lineitem")
def apply_mapping_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Select, rename and array-to-text mapping, lossless form."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_linenumber", F.array("l_orderkey", "l_partkey", "l_suppkey").alias("keys")
    )
    return apply_mapping(rows, [("keys", "array", "ids", "string")], keep=["l_linenumber"])


@query(
    """SELECT l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
              '[' || l_orderkey || ', ' || l_partkey || ', ' || l_suppkey || ']' AS ids FROM lineitem"""
)
def apply_mapping_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in display form, beside a plain cast."""
    rows = table(spark, sf_dir, "lineitem").withColumn("keys", F.array("l_orderkey", "l_partkey", "l_suppkey"))
    mappings = [
        ("keys", "array", "ids", "string"),
        ("l_quantity", "double", "quantity", "bigint"),
        ("l_linenumber", "int", "l_linenumber", "int"),
    ]
    return apply_mapping(rows, mappings, style="cast")


@query(
    """SELECT doc_id, CAST(json_array(lang, source) AS VARCHAR) AS tags FROM documents"""
)
def array_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array of texts as JSON text."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", array_text(F.array("lang", "source")).alias("tags")
    )


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '["' || lang || '","' || source || '"]'
                           WHEN doc_id % 5 = 1 THEN CAST(n_chars AS VARCHAR)
                           WHEN doc_id % 5 = 2 THEN lang END AS held,
              CASE WHEN doc_id % 5 = 3 THEN 'held=true' ELSE '' END AS bad
       FROM documents"""
)
def mapping_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is a list, a number, a text, a flag or absent: an entry for each type but the flag."""
    path = scratch(spark, "json")
    documents = table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 5
    line = (
        F.when(kind == 0, F.to_json(F.struct("doc_id", F.array("lang", "source").alias("held"))))
        .when(kind == 1, F.to_json(F.struct("doc_id", F.col("n_chars").alias("held"))))
        .when(kind == 2, F.to_json(F.struct("doc_id", F.col("lang").alias("held"))))
        .when(kind == 3, F.to_json(F.struct("doc_id", F.lit(True).alias("held"))))
        .otherwise(F.to_json(F.struct("doc_id")))
    )
    documents.select(line.alias("value")).write.text(path)
    mappings = [("doc_id", "bigint", "doc_id", "bigint")]
    mappings += [("held", declared, "held", "string") for declared in ("array", "bigint", "string")]
    mapped = apply_variant_mapping(read_variant_lines(spark, path), mappings)
    bad = F.array_join(F.transform("bad", lambda b: F.concat_ws("=", b["target"], b["held"])), ",")
    return mapped.select("doc_id", "held", bad.alias("bad"))


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS run FROM events
       UNION ALL SELECT event_id, 2 FROM events WHERE event_type = 'click'"""
)
def bookmarked_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three committed runs over a growing folder; the first one's files are replaced before the third."""
    root, ledger, out = scratch(spark, "drops"), scratch(spark, "ledger"), scratch(spark, "rows")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    schema = T.StructType.fromDDL("event_id BIGINT")

    def drop(name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").json(f"{root}/{name}")

    def run(number: int) -> None:
        rows = bookmarks.bookmarked_scan(spark, root, ledger, number, schema, "*.json")
        rows.select("event_id", F.lit(number).alias("run")).write.mode("overwrite").parquet(f"{out}/part={number}")

    drop("a", events.where("event_type = 'click'"))
    run(0)
    run(0)
    bookmarks.commit(spark, ledger, 0)
    drop("b", events.where("event_type = 'view'"))
    run(1)
    bookmarks.commit(spark, ledger, 1)
    drop("a", events.where("event_type = 'click'"))
    drop("c", events.where("event_type NOT IN ('click', 'view')"))
    run(2)
    bookmarks.commit(spark, ledger, 2)
    return spark.read.schema("event_id BIGINT, run INT").parquet(*[f"{out}/part={n}" for n in range(3)])
