"""Where each job goes next, from its newest run and the minute of the hour."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import in_gate, route
from tidemark.operators.status import job_status


def gate_and_route(
    runs: DataFrame, at: Column, jobs: DataFrame | None = None, order: tuple[str, ...] = ("started_at",)
) -> DataFrame:
    """Every job's newest action, the gate at ``at``, and the step that follows."""
    return (
        job_status(runs, jobs, order)
        .withColumn("check_status", in_gate(at))
        .withColumn("next_step", route(F.col("check_status"), F.col("action_status")))
    )
