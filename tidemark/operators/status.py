"""Export jobs and job runs: what is pending, finished, newest."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import COMPLETED, ERROR, action_status


def job_ids(jobs: DataFrame, job: str = "job_id") -> DataFrame:
    """Distinct job ids; combined per map task before the shuffle."""
    return jobs.select(job).distinct()


def pending_jobs(requested: DataFrame, done: DataFrame, job: str = "job_id") -> DataFrame:
    """Requested rows whose job is not done.

    The done side is reduced to distinct ids first, so a job listed many times moves once
    per map task. It is reduced by (hash of the id, id): the join then needs an exchange of
    its own above that, and adaptive execution may split a requested id that holds a large
    share of the rows, which it does only where both sides come straight from an exchange.
    """
    ids = done.select(F.xxhash64(job).alias("_hash"), job).distinct().select(job)
    return requested.join(ids, job, "left_anti")


def unsettled_jobs(requested: DataFrame, done: DataFrame, job: str = "job_id") -> DataFrame:
    """Ids in one set only; no rows means the sets are equal. One aggregate, no join."""
    both = requested.select(job, F.lit(1).alias("_r"), F.lit(0).alias("_d")).unionByName(
        done.select(job, F.lit(0).alias("_r"), F.lit(1).alias("_d"))
    )
    sides = both.groupBy(job).agg(F.max("_r").alias("_r"), F.max("_d").alias("_d"))
    return sides.where(F.col("_r") != F.col("_d")).select(
        job, F.when(F.col("_r") == 1, "requested").otherwise("done").alias("only_in")
    )


def completion_summary(jobs: DataFrame, keys: Sequence[str], state: str = "state") -> DataFrame:
    """Per key: are all jobs complete, did any fail."""
    return jobs.groupBy(*keys).agg(
        F.bool_and(F.col(state) == COMPLETED).alias("complete"),
        F.bool_or(F.col(state) == ERROR).alias("has_error"),
    )


def job_status(
    runs: DataFrame,
    jobs: DataFrame | None = None,
    order: Sequence[str] = ("started_at",),
    job: str = "job_name",
    state: str = "state",
) -> DataFrame:
    """Newest run of each job as an action; a listed job without runs must be polled."""
    newest = runs.groupBy(job).agg(F.max_by(state, F.struct(*order)).alias("run_state"))
    if jobs is not None:
        newest = jobs.select(job).distinct().join(newest, job, "left")
    return newest.withColumn("action_status", action_status(F.col("run_state")))


def newest_run(runs: DataFrame, order: Sequence[str] = ("started_at",), state: str = "state") -> DataFrame:
    """The single newest run: a top-1, kept per task before one row is chosen."""
    newest = runs.orderBy(*[F.col(c).desc() for c in order]).limit(1)
    return newest.withColumn("action_status", action_status(F.col(state)))
