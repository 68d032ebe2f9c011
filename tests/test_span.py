"""Exact-span de-duplication against plain Python, the streams, and the hot key of an anti join."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.span import dedup_within_span
from tidemark.operators.status import pending_jobs
from tidemark.streaming.span import dedup_within_span_stream

SPAN = 3 * 3_600_000_000
START = datetime(2024, 1, 1)
SCHEMA = "g string, body string, ts timestamp, n long"


def some_rows(seed, n=300):
    rng = random.Random(seed)
    return [
        (rng.choice("ab"), rng.choice(["x", "y", ""]), START + timedelta(minutes=rng.randrange(6000)), i)
        for i in range(n)
    ]


def brute(rows):
    kept, last = [], {}
    for g, body, at, _ in sorted(rows, key=lambda r: r[2]):
        if (g, body) not in last or at - last[g, body] >= timedelta(microseconds=SPAN):
            last[g, body] = at
            kept.append((g, body, at))
    return sorted(kept)


def test_batches_and_replays_equal_one_pass(spark, tmp_path):
    rows = sorted(some_rows(1), key=lambda r: r[2])
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole = dedup_within_span(frame, ["g"], "body", "ts", SPAN)
    assert sorted(tuple(r)[:3] for r in whole.collect()) == brute(rows)
    ledger, got = str(tmp_path / "ledger"), []
    for batch in range(3):
        part = spark.createDataFrame(rows[batch * 100 : batch * 100 + 100], SCHEMA)
        for _ in range(1 + (batch == 1)):
            kept = dedup_within_span(part, ["g"], "body", "ts", SPAN, ledger, batch).collect()
        got += [tuple(r)[:3] for r in kept]
    assert sorted(got) == brute(rows)


def test_ties_nulls_and_empty(spark):
    rows = [("a", "x", START, 1)] * 3 + [("a", None, START, 2), ("a", "x", None, 3), (None, "x", START, 4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["n"] for r in dedup_within_span(frame, ["g"], "body", "ts", SPAN).collect()) == [1, 2, 3, 4]
    assert dedup_within_span(frame.limit(0), ["g"], "body", "ts", SPAN).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(some_rows(2, 120), key=lambda r: r[2])
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:60], rows[60:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(SCHEMA).parquet(source).withWatermark("ts", "2 hours")
        dedup_within_span_stream(events, ["g"], "body", "ts", SPAN).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start(sink).awaitTermination()
    got = spark.read.schema(SCHEMA).parquet(sink).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute(rows)


def test_a_hot_job_is_split(spark, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id"))
        requested = spark.range(0, 200_000, 1, 8).select(hot.alias("job_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        done = spark.range(0, 300_000, 2, 8).select(F.col("id").alias("job_id"))
        found = pending_jobs(requested, done)
        text = plan(found, run=True)
        assert "skew=true" in text
        assert found.count() == sum(1 for i in range(200_000) if (7 if i % 3 else i) % 2)
    finally:
        for key in settings:
            spark.conf.unset(key)
