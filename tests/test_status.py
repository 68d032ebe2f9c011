from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.status import (
    completion_summary,
    job_ids,
    job_status,
    newest_run,
    pending_jobs,
    unsettled_jobs,
)
from tidemark.plans.gate import gate_and_route
from tidemark.schemas import EXPORT_JOBS, JOB_RUNS


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "job_id string")


def test_pending_and_sets(spark, rows):
    requested, done = ids(spark, "a", "b", "c"), ids(spark, "b", "b", "d")
    assert rows(pending_jobs(requested, done)) == [("a",), ("c",)]
    assert rows(unsettled_jobs(requested, done)) == [("a", "requested"), ("c", "requested"), ("d", "done")]
    assert unsettled_jobs(requested, ids(spark, "c", "a", "b", "a")).isEmpty()
    assert rows(job_ids(done)) == [("b",), ("d",)]


def test_pending_moves_hot_done_ids_once_per_task(spark, plan):
    done = spark.range(1000).select(F.lit("b").alias("job_id"))
    text = plan(pending_jobs(ids(spark, "a", "b"), done))
    assert "HashAggregate" in text and "CartesianProduct" not in text


def test_completion(spark, rows):
    jobs = spark.createDataFrame(
        [("a", "COMPLETED", None), ("b", "COMPLETED", None), ("c", "IN_PROGRESS", None), ("d", "ERROR", "e")], EXPORT_JOBS
    ).withColumn("request", F.when(F.col("job_id") < "c", "done").when(F.col("job_id") == "c", "running").otherwise("bad"))
    assert rows(completion_summary(jobs, ["request"])) == [
        ("bad", False, True),
        ("done", True, False),
        ("running", False, False),
    ]


RUNS = [
    ("ok", datetime(2024, 1, 1, 1), "SUCCEEDED"),
    ("bad", datetime(2024, 1, 1, 1), "FAILED"),
    ("busy", datetime(2024, 1, 1, 1), "SUCCEEDED"),
    ("busy", datetime(2024, 1, 1, 2), "RUNNING"),
]


def test_job_status(spark, rows):
    runs = spark.createDataFrame(RUNS, JOB_RUNS)
    jobs = spark.createDataFrame([("ok",), ("bad",), ("busy",), ("new",)], "job_name string")
    assert rows(job_status(runs, jobs)) == [
        ("bad", "FAILED", "FAILED"),
        ("busy", "RUNNING", "POLL"),
        ("new", None, "POLL"),
        ("ok", "SUCCEEDED", "SUCCEEDED"),
    ]
    assert rows(newest_run(runs), "job_name", "action_status") == [("busy", "POLL")]


def test_gate_and_route(spark, rows):
    runs = spark.createDataFrame(RUNS, JOB_RUNS)
    inside, outside = F.lit(datetime(2024, 1, 1, 3, 5)), F.lit(datetime(2024, 1, 1, 3, 10))
    assert rows(gate_and_route(runs, inside), "job_name", "next_step") == [("bad", "fail"), ("busy", "poll"), ("ok", "wait")]
    assert {r["next_step"] for r in gate_and_route(runs, outside).collect()} == {"succeed"}


def test_newest_run_is_a_top_one(spark, plan):
    assert "TakeOrderedAndProject(limit=1" in plan(newest_run(spark.createDataFrame(RUNS, JOB_RUNS)))
