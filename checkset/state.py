"""State rows: ready queue, put, update, latest version, expiry, status folders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkset import query, table
from tidemark.operators.latest import latest_by
from tidemark.operators.state import (
    STEP_PUT,
    STEP_UPDATE,
    append_state,
    current_state,
    drop_expired,
    put_revisions,
    read_state_log,
    ready_revisions,
    revisions_by_status,
    update_revisions,
    write_by_status,
)
from tidemark.schemas import SUCCESS
from tidemark.session import scratch


def order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as state rows: the priority is the data set, the order the revision."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset_id"),
        F.col("o_orderkey").cast("string").alias("revision_id"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    """SELECT o_orderpriority AS dataset_id, CAST(o_orderkey AS VARCHAR) AS revision_id, o_orderstatus AS status
       FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"""
)
def ready_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key equality and residual status filter, both in the scan."""
    return ready_revisions(order_state(spark, sf_dir), ["1-URGENT"], status="F")


@query(
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version per key, no ranking window."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return latest_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    """SELECT c_custkey, c_name, CASE WHEN u.last IS NULL THEN 'READY' ELSE 'SUCCESS' END AS status,
              u.last AS last_order
       FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last FROM orders
                                WHERE o_orderstatus = 'F' GROUP BY 1) u ON c_custkey = u.o_custkey"""
)
def update_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns set where a change exists, the rest kept."""
    state = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.lit("READY").alias("status"), F.lit(None).cast("long").alias("last_order")
    )
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    changes = finished.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.lit(SUCCESS).alias("status"), F.max("o_orderkey").alias("last_order")
    )
    return update_revisions(state, changes, ["status", "last_order"], ["c_custkey"])


@query(
    """SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
       UNION ALL SELECT c_custkey, -1 FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""
)
def put_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows replaced by key."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit(-1).cast("long").alias("v"))
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    new = finished.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("v"))
    return put_revisions(old, new, ["k"])


def _write_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: every order put, finished ones marked; urgent ones put again."""
    log = scratch(spark, "state")
    orders = order_state(spark, sf_dir)
    put = orders.withColumn("metadata", F.col("status")).withColumn("status", F.lit("READY"))
    append_state(put, log, 0, STEP_PUT)
    marked = put.where("metadata = 'F'").withColumn("status", F.lit(SUCCESS))
    append_state(marked, log, 0, STEP_UPDATE)
    append_state(put.where("dataset_id = '1-URGENT'"), log, 1, STEP_PUT)
    return read_state_log(spark, log)


@query(
    """SELECT o_orderpriority AS dataset_id, CAST(o_orderkey AS VARCHAR) AS revision_id,
              CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN 'SUCCESS' ELSE 'READY' END
              AS status
       FROM orders"""
)
def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version of every key over an append-only log."""
    return current_state(_write_log(spark, sf_dir)).select("dataset_id", "revision_id", "status")


@query(
    """SELECT o_orderpriority AS dataset_id, CAST(o_orderkey AS VARCHAR) AS revision_id,
              CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'READY' END AS status
       FROM orders"""
)
def state_log_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it stood after its first batch; later folders are pruned."""
    state = current_state(_write_log(spark, sf_dir), as_of=(0, STEP_UPDATE))
    return state.select("dataset_id", "revision_id", "status")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS revision_id FROM orders WHERE o_orderstatus = 'P'")
def by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status out of a status-partitioned snapshot."""
    path = scratch(spark, "by_status")
    write_by_status(order_state(spark, sf_dir), path)
    return revisions_by_status(spark.read.parquet(path), "P").select("revision_id")


@query(
    """SELECT event_id FROM events
       WHERE event_type = 'signup' OR epoch(ts) > 1704240000"""
)
def not_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an expiry or with one still ahead."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "signup", F.unix_timestamp(F.col("ts").cast("timestamp"))).alias(
            "time_to_exist"
        ),
    )
    return drop_expired(events, F.lit("2024-01-03 00:00:00")).select("event_id")
