"""The feed's own tables: snapshots, long lists, quarantine, file index, failed values."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from checkset.events import event_body
from checkset.scans import write_data_files
from checkset.state import order_state
from tidemark.operators.events import parse_events
from tidemark.operators.mapping import bad_values
from tidemark.operators.quarantine import quarantined, redrive, write_quarantine
from tidemark.operators.revisions import asset_chunks, build_revisions, data_assets, every_asset
from tidemark.operators.snapshots import drop_snapshots, state_as_of, write_snapshot
from tidemark.operators.state import STEP_PUT, STEP_UPDATE, append_state, put_revisions
from tidemark.schemas import KEYS, READY, SUCCESS
from tidemark.session import scratch
from tidemark.sinks.csv import CSV_OPTIONS, write_csv
from tidemark.sources.assets import list_files
from tidemark.sources.file_index import grow_index, indexed_listing, read_index

BATCHES = 6


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A log of six batches with snapshots after the third and the fifth; the fifth is replayed.

    Each batch puts a sixth of the orders and marks the finished ones; the fifth puts the
    urgent ones of the first again.
    """
    log, snapshots = scratch(spark, "state"), scratch(spark, "snapshots")
    orders = order_state(spark, sf_dir).withColumn("finished", F.col("status") == "F")
    sixth = F.col("revision_id").cast("long") % BATCHES
    put = orders.withColumn("status", F.lit(READY))

    def one(batch: int) -> None:
        drop_snapshots(spark, snapshots, batch)
        mine = put.where(sixth == batch)
        again = put.where((sixth == 0) & (F.col("dataset_id") == "1-URGENT")) if batch == 4 else put.limit(0)
        append_state(mine.unionByName(again), log, batch, STEP_PUT)
        marked = mine.where("finished").withColumn("status", F.lit(SUCCESS))
        append_state(marked, log, batch, STEP_UPDATE)
        if batch in (2, 4):
            write_snapshot(spark, log, snapshots, batch)

    for batch in (0, 1, 2, 3, 4, 4, 5):
        one(batch)
    return log, snapshots


COMPACTED_SQL = """SELECT o_orderpriority AS dataset_id, CAST(o_orderkey AS VARCHAR) AS revision_id,
       CASE WHEN o_orderstatus = 'F' AND NOT (o_orderkey % 6 = 0 AND o_orderpriority = '1-URGENT')
            THEN 'SUCCESS' ELSE 'READY' END AS status,
       CASE WHEN o_orderkey % 6 = 0 AND o_orderpriority = '1-URGENT' THEN 4 ELSE o_orderkey % 6 END AS batch
       FROM orders"""


@query(COMPACTED_SQL)
def state_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version of every key from the newest snapshot and the batches after it."""
    return state_as_of(spark, *_compacted(spark, sf_dir)).select(*KEYS, "status", "batch")


@query(f"SELECT dataset_id, revision_id FROM ({COMPACTED_SQL}) WHERE status = 'SUCCESS'")
def status_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one status: one folder of the snapshot, and the later batches."""
    return state_as_of(spark, *_compacted(spark, sf_dir), status=SUCCESS).select(*KEYS)


@query(
    """SELECT event_type AS dataset_id, CAST(event_id AS VARCHAR) AS revision_id FROM events
       WHERE event_type = 'signup' OR epoch(ts) > 1704240000 OR event_id % 7 = 0"""
)
def expired_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expired rows leave with the next snapshot; a later put of such a key counts again."""
    log, snapshots = scratch(spark, "state"), scratch(spark, "snapshots")
    expiry = F.when(F.col("event_type") != "signup", F.unix_timestamp(F.col("ts").cast("timestamp")))
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset_id"),
        F.col("event_id").cast("string").alias("revision_id"),
        F.lit(READY).alias("status"),
        expiry.alias("time_to_exist"),
    )
    append_state(rows, log, 0, STEP_PUT)
    write_snapshot(spark, log, snapshots, 0, F.lit("2024-01-03 00:00:00"))
    late = rows.where(F.col("revision_id").cast("long") % 7 == 0).withColumn("time_to_exist", F.lit(None).cast("long"))
    append_state(late, log, 1, STEP_PUT)
    return state_as_of(spark, log, snapshots).select(*KEYS)


@query(
    """SELECT c_custkey AS k, coalesce(o.v, -1) AS v FROM customer LEFT JOIN (
         SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY 1) o
       ON c_custkey = o_custkey"""
)
def put_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows replaced by key, the last of several new rows of a key counting."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit(-1).cast("long").alias("v"))
    new = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderdate").alias("at")
    )
    return put_revisions(old, new, ["k"], order=["at", "v"])


def long_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the files of a few revisions: each has a large share of all."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("dataset_id"),
        F.col("l_linestatus").alias("revision_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat_ws("-", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("name"),
    )


LONG_SQL = """SELECT l_returnflag AS dataset_id, l_linestatus AS revision_id,
       row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey * 10 + l_linenumber,
                          concat_ws('-', l_partkey, l_suppkey, l_quantity, l_extendedprice)) - 1 AS place,
       l_orderkey * 10 + l_linenumber AS pos
       FROM lineitem"""


@query(
    f"""SELECT l.dataset_id, l.revision_id, CAST(l.place AS INTEGER) AS pos, n.n AS n_data_files
        FROM ({LONG_SQL}) l JOIN (SELECT l_returnflag AS dataset_id, l_linestatus AS revision_id, count(*) AS n
                                  FROM lineitem GROUP BY 1, 2) n USING (dataset_id, revision_id)"""
)
def long_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of revisions whose list is too long for one row, numbered in listing order."""
    files = long_listing(spark, sf_dir)
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    revisions = build_revisions(files, "b", "in", at)
    tall = data_assets(files, "b", "in", at)
    return every_asset(revisions, tall).select(*KEYS, "pos", "n_data_files")


@query(
    f"""SELECT dataset_id, revision_id, place // 1000 AS chunk, count(*) AS n, min(pos) AS first, max(pos) AS last
        FROM ({LONG_SQL}) GROUP BY 1, 2, 3"""
)
def long_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lists in chunks of a thousand, numbered without gaps."""
    chunks = asset_chunks(data_assets(long_listing(spark, sf_dir), "b", "in", F.lit("2024-01-02").cast("timestamp")))
    return chunks.select(
        *KEYS,
        "chunk",
        F.size("assets").cast("long").alias("n"),
        F.element_at("assets", 1)["pos"].alias("first"),
        F.element_at("assets", -1)["pos"].alias("last"),
    )


def _mixed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An envelope per event; sign-ups are in order, each other type is refused for a reason of its own."""
    user = F.array(F.concat(F.lit("u"), "user_id"))
    revision = F.concat(F.lit("r"), "event_id")
    none = F.array().cast("array<string>")
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", F.concat(F.lit("{broken "), revision))
        .when(kind == "click", event_body(F.lit("x"), none, F.array(revision)))
        .when(kind == "purchase", event_body(F.concat(F.lit("x"), revision), user, none))
        .otherwise(event_body(F.lit("x"), user, F.array(revision)))
    )
    wrapped = F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records")))
    return table(spark, sf_dir, "events").select(
        F.when(kind == "error", F.concat(F.lit("broken "), revision)).otherwise(wrapped).alias("value")
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'envelope is not JSON' WHEN 'view' THEN 'body is not JSON'
                             WHEN 'click' THEN 'no data set' WHEN 'purchase' THEN 'no revision' END AS reason,
              CAST(1 AS BIGINT) AS copies
       FROM events WHERE event_type IN ('error', 'view', 'click', 'purchase')"""
)
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every refused record with its raw text and the reason."""
    refused = quarantined(_mixed_envelopes(spark, sf_dir))
    number = F.regexp_extract("value", r"r(\d+)(\D|$)", 1).cast("long")
    return refused.select(number.alias("event_id"), "reason", "copies")


@query(
    """SELECT CASE event_type WHEN 'error' THEN 1 ELSE 2 END AS batch, 'd' AS dataset_id, 'r' || event_id AS revision_id
       FROM events WHERE event_type IN ('error', 'view')"""
)
def feed_redriven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused records repaired and fed back, once each, although both batches run twice."""
    quarantine, redriven = scratch(spark, "quarantine"), scratch(spark, "redriven")
    write_quarantine(_mixed_envelopes(spark, sf_dir), quarantine, 0)

    def repaired(reasons: list[str]):
        revision = F.regexp_extract("value", r"(r\d+)", 1)
        body = event_body(F.lit("x"), F.array(F.lit("d")), F.array(revision))
        value = F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records")))
        return lambda rows: rows.where(F.col("reason").isin(*reasons)).withColumn("value", value)

    out = None
    for batch, reasons in ((1, ["envelope is not JSON"]), (2, ["envelope is not JSON", "body is not JSON"])):
        for _ in range(2):
            back = redrive(spark, quarantine, redriven, batch, repaired(reasons))
        rows = parse_events(back).select(F.lit(batch).alias("batch"), *KEYS)
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    """SELECT DISTINCT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id, true AS has_bytes,
              true AS once
       FROM events WHERE event_type IN ('click', 'purchase')"""
)
def listing_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested revisions out of a file index that grew twice, beside an earlier output of the same form."""
    root, index = scratch(spark, "root"), scratch(spark, "index")
    layout = "in/dataset_id={dataset_id}/revision_id={revision_id}"
    write_data_files(spark, sf_dir, f"{root}/in")
    write_data_files(spark, sf_dir, f"{root}/out")
    grow_index(spark, root, layout, index, 0)
    grow_index(spark, root, layout, index, 1)
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase"))
    asked = events.select(
        F.col("event_type").alias("dataset_id"), F.date_format("ts", "yyyy-MM-dd").alias("revision_id")
    )
    found = indexed_listing(asked, index)
    entries = spark.read.parquet(f"{index}/batch=*").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    per = found.join(entries, "key").groupBy(*KEYS)
    return per.agg((F.sum("bytes") > 0).alias("has_bytes"), (F.max("n") == 1).alias("once"))


@query("SELECT event_type AS dataset_id, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS n_revisions FROM events GROUP BY 1")
def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole index: every input file with its ids, read from the layout of its key."""
    root, index = scratch(spark, "root"), scratch(spark, "index")
    write_data_files(spark, sf_dir, f"{root}/in")
    grow_index(spark, root, "in/dataset_id={dataset_id}/revision_id={revision_id}", index, 0)
    return read_index(spark, index).groupBy("dataset_id").agg(F.count_distinct("revision_id").alias("n_revisions"))


@query(
    """SELECT l_orderkey, l_linenumber, 'part' AS target, 'x' || l_partkey AS held FROM lineitem
       WHERE l_returnflag = 'R'"""
)
def mapping_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a mapping can't cast, each with its text and target."""
    part = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("x"), "l_partkey"))
    part = part.otherwise(F.col("l_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", part.alias("part_text"), F.col("l_quantity").alias("quantity")
    )
    mappings = [("part_text", "string", "part", "bigint"), ("quantity", "double", "quantity", "int")]
    return bad_values(rows, mappings, ["l_orderkey", "l_linenumber"])


@query("SELECT s_suppkey, s_name, CAST(1 AS BIGINT) AS n_files FROM supplier")
def csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output file on request, for small output."""
    path = scratch(spark, "csv")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").repartition(4)
    write_csv(rows, path, single_file=True)
    back = spark.read.schema("s_suppkey BIGINT, s_name STRING").options(**CSV_OPTIONS).csv(path)
    return back.withColumn("n_files", F.lit(list_files(spark, path, "part-*").count()).cast("long"))
