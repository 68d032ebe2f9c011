"""Jobs followed as a stream: what settles a key, and what is held for it."""

from pyspark.sql import functions as F

from tidemark.streaming.span import track_jobs

SCHEMA = "k STRING, job_id STRING, state STRING, n_jobs BIGINT, ts TIMESTAMP"


def follow(spark, tmp_path, *drops):
    """Settled keys of ``drops`` in turn, and the bytes of state held after each."""
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    held = []
    for drop in drops:
        drop.write.mode("append").parquet(source)
        events = spark.readStream.schema(SCHEMA).parquet(source).withWatermark("ts", "1 hour")
        run = track_jobs(events, ["k"], "ts", 86_400_000).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        )
        run = run.trigger(availableNow=True).start(sink)
        run.awaitTermination()
        held.append(max(p["stateOperators"][0]["memoryUsedBytes"] for p in run.recentProgress))
    found = spark.read.schema("k STRING, status STRING, n_done BIGINT").parquet(sink)
    return sorted(tuple(r) for r in found.collect()), held


def drop_of(spark, *rows):
    return spark.createDataFrame(rows, "k string, job_id string, state string, n_jobs long, at string").select(
        "k", "job_id", "state", "n_jobs", F.to_timestamp("at").alias("ts")
    )


def test_jobs_settle_whatever_the_order_of_their_rows(spark, tmp_path):
    first = drop_of(
        spark,
        ("done", "a", "COMPLETED", 3, "2024-01-01 01:00:00"),
        ("done", "a", "COMPLETED", 3, "2024-01-01 02:00:00"),
        ("done", "b", "COMPLETED", 3, "2024-01-01 01:00:00"),
        ("failed", "c", "COMPLETED", 4, "2024-01-01 03:00:00"),
        ("failed", "b", "ERROR", 4, "2024-01-01 02:00:00"),
        ("failed", "a", "COMPLETED", 4, "2024-01-01 01:00:00"),
        ("grown", "a", "COMPLETED", 1, "2024-01-01 02:00:00"),
        ("grown", "b", "COMPLETED", 2, "2024-01-01 01:00:00"),
        ("late", "a", "COMPLETED", 2, "2024-01-01 01:00:00"),
        ("late", "b", "RUNNING", 2, "2024-01-01 01:00:00"),
    )
    second = drop_of(
        spark, ("done", "c", "COMPLETED", 3, "2024-01-01 03:00:00"), ("done", "d", "ERROR", 3, "2024-01-01 04:00:00")
    )
    end = drop_of(spark, ("x", "x", "RUNNING", 1, "2024-02-01 00:00:00"))
    settled, _ = follow(spark, tmp_path, first, second, end)
    assert settled == [
        ("done", "COMPLETED", 3), ("failed", "ERROR", 1), ("grown", "COMPLETED", 2), ("late", "TIMED_OUT", 1)
    ]


def test_a_key_holds_few_bytes_for_each_job(spark, tmp_path):
    jobs = spark.range(20_000).select(
        F.lit("k").alias("k"),
        F.concat(F.lit("job-of-some-length-"), "id").alias("job_id"),
        F.lit("COMPLETED").alias("state"),
        F.lit(20_001).cast("long").alias("n_jobs"),
        F.to_timestamp(F.lit("2024-01-01")).alias("ts"),
    )
    last = drop_of(spark, ("k", "last", "COMPLETED", 20_001, "2024-01-01 00:30:00"))
    settled, held = follow(spark, tmp_path, jobs, jobs, last)
    assert settled == [("k", "COMPLETED", 20_001)]
    assert held[0] < 12 * 20_000
