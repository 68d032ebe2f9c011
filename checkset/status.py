"""Export jobs, job runs, gate and routing."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.functions.status import action_status, in_gate, route
from tidemark.operators.status import (
    completion_summary,
    job_ids,
    job_status,
    newest_run,
    pending_jobs,
    unsettled_jobs,
)
from tidemark.plans.gate import gate_and_route

# Order status as run state: F finished well, P failed, O is still running.
RUN_STATE_SQL = "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END"
ACTION_SQL = "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'FAILED' ELSE 'POLL' END"


def run_state() -> Column:
    finished, failed = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"
    return F.when(finished, "SUCCEEDED").when(failed, "FAILED").otherwise("RUNNING")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("job_name"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderkey").alias("run_id"),
        run_state().alias("state"),
    )


@query(f"SELECT o_orderkey, {ACTION_SQL} AS action_status FROM orders")
def status_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run state to action."""
    return table(spark, sf_dir, "orders").select("o_orderkey", action_status(run_state()).alias("action_status"))


@query(
    f"""SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'succeed'
               ELSE CASE {ACTION_SQL} WHEN 'SUCCEEDED' THEN 'wait' WHEN 'FAILED' THEN 'fail' ELSE 'poll' END END
               AS next_step
        FROM orders"""
)
def next_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing on the gate flag and the action."""
    gate = F.col("o_totalprice") >= 100000
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", route(gate, action_status(run_state())).alias("next_step")
    )


@query("SELECT event_id, minute(ts) < 10 AS gate FROM events")
def minute_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten minutes of the hour."""
    return table(spark, sf_dir, "events").select("event_id", in_gate(F.col("ts")).alias("gate"))


@query("SELECT DISTINCT l_orderkey AS job_id FROM lineitem")
def distinct_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set of job ids."""
    return job_ids(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_id")))


@query(
    """SELECT o_orderkey AS job_id FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')"""
)
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested jobs without a completed one."""
    requested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"))
    done = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("job_id"))
    return pending_jobs(requested, done)


@query(
    """SELECT o_orderkey AS job_id, 'requested' AS only_in FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
       UNION ALL SELECT DISTINCT l_orderkey, 'done' FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""
)
def unsettled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in one of two sets only."""
    requested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_id"))
    return unsettled_jobs(requested, done)


@query(
    """SELECT l_orderkey, bool_and(l_linestatus = 'F') AS complete,
              bool_or(l_linestatus <> 'F' AND l_returnflag = 'R') AS has_error
       FROM lineitem GROUP BY 1"""
)
def completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All complete, any failed, per key."""
    jobs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linestatus") == "F", "COMPLETED")
        .when(F.col("l_returnflag") == "R", "ERROR")
        .otherwise("IN_PROGRESS")
        .alias("state"),
    )
    return completion_summary(jobs, ["l_orderkey"])


@query(
    f"""SELECT c_custkey AS job_name, r.state AS run_state,
               CASE WHEN r.state IN ('SUCCEEDED', 'FAILED') THEN r.state ELSE 'POLL' END AS action_status
        FROM customer LEFT JOIN (
          SELECT o_custkey, {RUN_STATE_SQL} AS state FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) r
        ON c_custkey = r.o_custkey"""
)
def newest_run_per_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest run of every job; a job without runs is polled."""
    jobs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_name"))
    return job_status(runs(spark, sf_dir), jobs, ["started_at", "run_id"])


@query(
    f"""SELECT o_custkey AS job_name, o_orderkey AS run_id, {RUN_STATE_SQL} AS state, {ACTION_SQL} AS action_status
        FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1"""
)
def newest_run_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one newest run."""
    return newest_run(runs(spark, sf_dir), ["started_at", "run_id"]).drop("started_at")


@query(
    f"""SELECT o_custkey AS job_name, {RUN_STATE_SQL} AS run_state, {ACTION_SQL} AS action_status,
               true AS check_status,
               CASE {ACTION_SQL} WHEN 'SUCCEEDED' THEN 'wait' WHEN 'FAILED' THEN 'fail' ELSE 'poll' END AS next_step
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def gated_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest run, action and next step of every job, five minutes past the hour."""
    at = F.lit("2024-02-01 07:05:00").cast("timestamp")
    return gate_and_route(runs(spark, sf_dir), at, order=("started_at", "run_id"))
