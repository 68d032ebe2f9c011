"""Streaming forms and the whole feed, over data files derived from the events."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checkset import query, table
from checkset.events import event_body
from checkset.messages import place_in_group
from checkset.scans import EVENT_LINE, write_data_files
from tidemark.functions.status import COMPLETED, ERROR
from tidemark.functions.text import decoded_path, parent
from tidemark.operators.events import parse_events
from tidemark.plans.feed import Feed, feed_state, run_batch, stored
from tidemark.schemas import KEYS
from tidemark.session import scratch
from tidemark.sinks.csv import CSV_OPTIONS
from tidemark.sources.assets import list_files, list_requested, path_segment
from tidemark.sources.events import stream_events
from tidemark.sources.json_lines import stream_json_lines
from tidemark.streaming.dedup import dedup_events_stream
from tidemark.streaming.feed import run_stream
from tidemark.streaming.span import track_jobs


@query("SELECT event_id, user_id, event_type, value FROM events")
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, three runs on one checkpoint: every row exactly once."""
    source, sink, checkpoint = (scratch(spark, n) for n in ("drops", "rows", "checkpoint"))
    events = table(spark, sf_dir, "events").drop("ts", "props")
    schema = T.StructType.fromDDL(EVENT_LINE)

    def run() -> None:
        lines = stream_json_lines(spark, source, schema).drop("_corrupt_record")
        lines.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start(sink).awaitTermination()

    events.where("event_type = 'click'").write.mode("append").json(source)
    run()
    events.where("event_type <> 'click'").write.mode("append").json(source)
    run()
    run()
    return spark.read.schema(schema).parquet(sink)


@query("SELECT DISTINCT event_type, user_id FROM events")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content de-duplication on a stream, with a span longer than the data."""
    sink, checkpoint = scratch(spark, "rows"), scratch(spark, "checkpoint")
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select("event_type", "user_id", F.col("user_id").cast("string").alias("body"), F.col("ts").cast("timestamp"))
    )
    dedup_events_stream(events, ["event_type"], "body", "ts", "60 days").select(
        "event_type", "user_id"
    ).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(
        sink
    ).awaitTermination()
    return spark.read.schema("event_type STRING, user_id BIGINT").parquet(sink)


FEED_SQL = """SELECT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id, 'SUCCESS' AS status,
                     count(*) AS n_rows FROM events GROUP BY 1, 2"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per revision of the data files."""
    revisions = table(spark, sf_dir, "events").select(
        "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    ).distinct()
    body = event_body(F.lit("exchange"), F.array("event_type"), F.array("day"))
    return revisions.select(F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records"))).alias("value"))


def _feed(spark: SparkSession, sf_dir: str, **choices) -> Feed:
    root = scratch(spark, "root")
    write_data_files(spark, sf_dir, f"{root}/in")
    return Feed(root, scratch(spark, "work"), "b", ("exchange",), ("published",), **choices)


def _listing(feed: Feed):
    return lambda requested: list_requested(
        requested, feed.root, "in/dataset_id={dataset_id}/revision_id={revision_id}"
    )


def _outcome(spark: SparkSession, feed: Feed) -> DataFrame:
    """State of every revision beside its CSV rows."""
    path = decoded_path(F.col("_metadata.file_path"))
    rows = (
        spark.read.schema("timestampssincelastrevision STRING")
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .csv(f"{feed.root}/{feed.csv_prefix}")
        .select("timestampssincelastrevision", path_segment(path, -4 if not feed.named else -3).alias("dataset_id"),
                path_segment(path, -3 if not feed.named else -2).alias("revision_id"))
    )
    counts = rows.groupBy(*KEYS).agg(F.count("timestampssincelastrevision").alias("n_rows"))
    return feed_state(feed, spark).select(*KEYS, "status").join(counts, KEYS, "left")


@query(FEED_SQL)
def feed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed as one batch, partitioned CSV: events in, state and CSV out."""
    feed = _feed(spark, sf_dir, named=False)
    run_batch(feed, _requests(spark, sf_dir), _listing(feed), 0, datetime(2024, 2, 1, 5))
    return _outcome(spark, feed)


@query(
    """SELECT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id FROM events GROUP BY 1, 2"""
)
def feed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the feed is asked for."""
    return parse_events(_requests(spark, sf_dir))


#: Slices of a revision: each is one file of the feed whose messages are looked at.
SLICES = 3


def _told(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Messages of a feed over files of known names, with their place in their data set."""
    root = scratch(spark, "root")
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("revision_id"),
        (F.col("user_id") % SLICES).alias("slice"),
        F.to_json(F.struct(F.array("props").alias("timestampssincelastrevision"))).alias("value"),
    )
    by = [*KEYS, "slice"]
    events.repartition(*by).write.partitionBy(*by).text(f"{root}/in")

    def listing(_: DataFrame) -> DataFrame:
        files = list_files(spark, root, "part-*", [f"{root}/in"])
        pos = path_segment(F.col("key"), -2).cast("long")
        name = F.concat(F.lit("f"), pos, F.lit(".json"))
        return files.select(
            path_segment(F.col("key"), -4).alias("dataset_id"),
            path_segment(F.col("key"), -3).alias("revision_id"),
            pos.alias("pos"),
            name.alias("name"),
            F.concat(parent(F.col("key")), F.lit("/"), name).alias("key"),
            "file_path",
            "bytes",
        )

    feed = Feed(root, scratch(spark, "work"), "b", ("exchange",), ("published",), mode=mode)
    run_batch(feed, _requests(spark, sf_dir), listing, 0, datetime(2024, 2, 1, 5))
    schema = "dataset_id STRING, revision_id STRING, pos BIGINT, name STRING, message STRING"
    back = spark.read.schema(schema).json(feed.folder("messages", 0))
    return place_in_group(
        back.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")),
        "dataset_id",
    )


FILES_SQL = """WITH files AS (
         SELECT DISTINCT event_type AS dataset_id, strftime(ts, '%Y-%m-%d') AS revision_id, user_id % 3 AS pos,
                'dataset_id=' || event_type || '/revision_id=' || strftime(ts, '%Y-%m-%d') AS folder FROM events),
       keys AS (
         SELECT *, 'heartbeat_csv/batch=0/' || folder || '/asset_stem=f' || pos AS csv_key,
                'in/' || folder || '/slice=' || pos || '/f' || pos || '.json' AS key FROM files)"""


def _message_sql(key: str) -> str:
    return f"""'{{"dataset_id":"' || b.dataset_id || '","revision_id":"' || b.revision_id
                || '","dataFilesMap":{{"heartbeat":['
                || string_agg('{{"bucket":"b","key":"' || {key} || '","version":null}}', ',' ORDER BY b.pos) || ']}}}}'"""


@query(
    f"""{FILES_SQL}, texts AS (
          SELECT dataset_id, revision_id, {_message_sql("csv_key")} AS message FROM keys b GROUP BY 1, 2)
        SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY revision_id) AS nth FROM texts"""
)
def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the feed sends: the text of every revision's message and its place in its data set."""
    return _told(spark, sf_dir, "revision").select("dataset_id", "revision_id", "message", "nth")


@query(
    f"""{FILES_SQL}, texts AS (
          SELECT b.dataset_id, b.revision_id, a.pos,
                 {_message_sql("CASE WHEN b.pos <= a.pos THEN b.csv_key ELSE b.key END")} AS message
          FROM keys a JOIN keys b ON a.dataset_id = b.dataset_id AND a.revision_id = b.revision_id GROUP BY 1, 2, 3)
        SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY revision_id, pos) AS nth FROM texts"""
)
def feed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in progress mode: a message per converted file, done keys so far, in order."""
    return _told(spark, sf_dir, "progress").select("dataset_id", "revision_id", "pos", "message", "nth")


@query(FEED_SQL)
def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the stream, in two drops of events and with a third, empty run."""
    feed = _feed(spark, sf_dir, named=False)
    queue, checkpoint = scratch(spark, "queue"), scratch(spark, "checkpoint")
    requests = _requests(spark, sf_dir)

    def run() -> None:
        run_stream(feed, stream_events(spark, queue), _listing(feed), checkpoint).awaitTermination()

    late = F.col("value").contains("purchase")
    requests.where(~late).write.mode("append").text(queue)
    run()
    requests.where(late).write.mode("append").text(queue)
    run()
    run()
    return _outcome(spark, feed)


JOBS_SQL = """SELECT l_suppkey, l_linenumber, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_quantity
                || '-' || l_extendedprice AS job_id,
              CASE WHEN l_partkey % 997 = 0 THEN 'ERROR' WHEN l_orderkey % 499 = 0 THEN 'RUNNING' ELSE 'COMPLETED' END
              AS state FROM lineitem"""


@query(
    f"""WITH jobs AS ({JOBS_SQL}),
        failed AS (SELECT l_suppkey, min((l_linenumber, job_id)) AS first FROM jobs WHERE state = 'ERROR' GROUP BY 1),
        told AS (
          SELECT j.l_suppkey, bool_and(state = 'COMPLETED') AS complete, any_value(f.first) IS NOT NULL AS has_error,
                 count(DISTINCT job_id) FILTER (WHERE state = 'COMPLETED'
                   AND (f.first IS NULL OR (l_linenumber, job_id) < f.first)) AS n_done
          FROM jobs j LEFT JOIN failed f ON f.l_suppkey = j.l_suppkey GROUP BY 1)
        SELECT l_suppkey, CASE WHEN has_error THEN 'ERROR' WHEN complete THEN 'COMPLETED' ELSE 'TIMED_OUT' END AS status,
               n_done FROM told"""
)
def jobs_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of every supplier followed through three drops; what doesn't settle runs into its deadline."""
    source, sink, checkpoint = (scratch(spark, n) for n in ("jobs", "settled", "checkpoint"))
    lines = table(spark, sf_dir, "lineitem")
    failed, running = F.col("l_partkey") % 997 == 0, F.col("l_orderkey") % 499 == 0
    job_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    jobs = lines.select(
        "l_suppkey",
        job_id.alias("job_id"),
        F.when(failed, ERROR).when(running, "RUNNING").otherwise(COMPLETED).alias("state"),
        F.timestamp_add("HOUR", F.col("l_linenumber"), F.lit("2024-01-01").cast("timestamp")).alias("ts"),
        "l_linenumber",
    )
    # jobs of one name are one job
    per = jobs.groupBy("l_suppkey").agg(F.count_distinct("job_id").alias("n_jobs"))
    # counted once, not again with every drop
    per = stored(per, scratch(spark, "per"))
    jobs = jobs.join(per, "l_suppkey")
    late = spark.createDataFrame([(-1, "none", "RUNNING", 0, 2)], "l_suppkey long, job_id string, state string, l_linenumber int, n_jobs long")
    late = late.withColumn("ts", F.lit("2024-03-01").cast("timestamp"))
    schema = "l_suppkey BIGINT, job_id STRING, state STRING, n_jobs BIGINT, ts TIMESTAMP"
    drops = [jobs.where("l_linenumber <= 2"), jobs.where("l_linenumber BETWEEN 3 AND 4"), jobs.where("l_linenumber > 4"), late]
    for drop in drops:
        drop.select(*[F.col(c).cast(t) for c, t in (x.split() for x in schema.split(", "))]).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source).withWatermark("ts", "1 hour")
        tracked = track_jobs(events, ["l_suppkey"], "ts", 14 * 86_400_000)
        tracked.select("l_suppkey", "status", "n_done").writeStream.format("parquet").option(
            "checkpointLocation", checkpoint
        ).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema("l_suppkey BIGINT, status STRING, n_done BIGINT").parquet(sink)
