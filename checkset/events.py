"""Event rule, envelope parsing, content de-duplication."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.functions.text import content_hash
from tidemark.operators.events import dedup_events, event_rule, match_events, parse_events, unreadable_events
from tidemark.operators.span import dedup_within_span, micros
from tidemark.session import scratch


def event_body(source, resources, revision_ids):
    """Body text of a queue record."""
    return F.to_json(
        F.struct(
            source.alias("source"),
            F.lit("published").alias("detail-type"),
            resources.alias("resources"),
            F.struct(revision_ids.alias("RevisionIds")).alias("detail"),
        )
    )


def named(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event: sign-ups start by hand, all others bring two records."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    first = event_body(
        F.col("event_type"),
        F.array(named("u", "user_id")),
        F.array(named("r", "event_id"), named("s", "event_id")),
    )
    second = event_body(F.col("event_type"), F.array(named("k", "k")), F.array(named("t", "event_id")))
    manual = F.struct(
        F.struct(
            named("u", "user_id").alias("data_set_id"), named("r", "event_id").alias("RevisionIds")
        ).alias("InitialInit")
    )
    queued = F.struct(F.array(F.struct(first.alias("body")), F.struct(second.alias("body"))).alias("Records"))
    by_hand = F.col("event_type") == "signup"
    return events.select(F.when(by_hand, F.to_json(manual)).otherwise(F.to_json(queued)).alias("value"))


@query(
    """SELECT event_id, event_type IN ('click', 'error') AND CAST(json_extract(props, '$.k') AS BIGINT) >= 50
         AND (hour(ts) < 12 OR CAST(json_extract(props, '$.k') AS BIGINT) = 77) AS matched
       FROM events"""
)
def event_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and type in a list, and at least one resource in a list."""
    k = F.get_json_object("props", "$.k")
    half = F.when(F.hour("ts") < 12, "morning").otherwise("evening")
    event = F.struct(
        F.col("event_type").alias("source"),
        F.when(k.cast("int") >= 50, "high").otherwise("low").alias("detail-type"),
        F.array(half, F.concat(F.lit("k"), k)).alias("resources"),
    )
    events = table(spark, sf_dir, "events").select("event_id", event.alias("event"))
    rule = event_rule(F.col("event"), ["click", "error"], ["high"], ["morning", "k77"])
    return events.select("event_id", rule.alias("matched"))


@query(
    """SELECT event_id FROM events
       WHERE event_type IN ('click', 'error') AND hour(ts) >= 12"""
)
def matched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule as a filter."""
    half = F.when(F.hour("ts") < 12, "morning").otherwise("evening")
    event = F.struct(
        F.col("event_type").alias("source"),
        F.lit("published").alias("detail-type"),
        F.array(half).alias("resources"),
    )
    events = table(spark, sf_dir, "events").select("event_id", event.alias("event"))
    return match_events(events, ["click", "error"], ["published"], ["evening"]).select("event_id")


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
       WHERE event_type IN ('click', 'error')"""
)
def event_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text parsed with a schema, after a filter that reaches the scan."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "error"))
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query(
    """SELECT 'u' || user_id AS dataset_id, 'r' || event_id AS revision_id FROM events
       UNION ALL SELECT 'u' || user_id, 's' || event_id FROM events WHERE event_type <> 'signup'
       UNION ALL SELECT 'k' || json_extract_string(props, '$.k'), 't' || event_id FROM events
                 WHERE event_type <> 'signup'"""
)
def event_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both envelope forms to (data set, revision) rows, every record and id."""
    return parse_events(envelopes(spark, sf_dir))


@query(
    """SELECT 'u' || user_id AS dataset_id, 'r' || event_id AS revision_id FROM events
       WHERE event_type = 'signup'
       UNION ALL SELECT 'k' || json_extract_string(props, '$.k'), 't' || event_id FROM events
                 WHERE event_type <> 'signup'"""
)
def last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last record of each envelope; no shuffle, the batch is in the row."""
    return parse_events(envelopes(spark, sf_dir), last_only=True)


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'broken' ELSE 'unnamed' END AS kind
       FROM events WHERE event_type IN ('error', 'view')"""
)
def unreadable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose body does not parse, or that name no data set."""
    good = event_body(F.col("event_type"), F.array(named("u", "user_id")), F.array(named("r", "event_id")))
    unnamed = event_body(F.col("event_type"), F.array().cast("array<string>"), F.array(named("r", "event_id")))
    body = F.when(F.col("event_type") == "error", "{broken").when(F.col("event_type") == "view", unnamed)
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct(F.array(F.struct(body.otherwise(good).alias("body"))).alias("Records"))).alias("value"),
    )
    return unreadable_events(raw).select(
        "event_id", F.when(F.col("body") == "{broken", "broken").otherwise("unnamed").alias("kind")
    )


@query("SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies per content hash of the whole text."""
    documents = table(spark, sf_dir, "documents").select(content_hash(F.col("text")).alias("h"))
    return documents.groupBy("h").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT lang, min(doc_id) AS doc_id, text FROM documents GROUP BY lang, text"""
)
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest of equal bodies in each group."""
    documents = table(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    return dedup_events(documents, ["lang"], "text", ["doc_id"])


SPAN_HOURS = 36


@query(
    f"""WITH RECURSIVE ordered AS (
          SELECT event_type, user_id, epoch_us(ts) AS t FROM events),
        kept AS (
          SELECT event_type, user_id, min(t) AS t FROM ordered GROUP BY 1, 2
          UNION ALL
          SELECT k.event_type, k.user_id, min(o.t) AS t FROM kept k JOIN ordered o
            ON o.event_type = k.event_type AND o.user_id = k.user_id AND o.t >= k.t + {SPAN_HOURS * 3_600_000_000}
          GROUP BY 1, 2)
        SELECT event_type, user_id, t AS at_micros FROM kept"""
)
def span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies within the span after the last accepted one go, over three batches and one replay."""
    ledger = scratch(spark, "ledger")
    events = table(spark, sf_dir, "events").select("event_type", F.col("user_id").cast("string").alias("body"), "user_id", "ts")
    out = None
    for batch, (low, high) in enumerate([("2000", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2100")]):
        part = events.where((F.col("ts") >= low) & (F.col("ts") < high))
        for _ in range(2 if batch == 1 else 1):
            kept = dedup_within_span(part, ["event_type"], "body", "ts", SPAN_HOURS * 3_600_000_000, ledger, batch)
        out = kept if out is None else out.unionByName(kept)
    return out.select("event_type", "user_id", micros(F.col("ts")).alias("at_micros"))
