"""State rows dealt out in bounded numbers before anything sorts them."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sizing
from tidemark.operators.snapshots import state_as_of, write_snapshot
from tidemark.operators.state import STEP_PUT, STEP_UPDATE, append_state, write_by_status
from tidemark.schemas import READY, SUCCESS


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(sizing, "TASK_ROWS", 100)


def test_state_is_dealt_out_by_rows(spark, tmp_path, few_rows):
    log, snapshots = str(tmp_path / "log"), str(tmp_path / "snapshots")
    for batch in range(3):
        rows = spark.range(1000 * batch, 1000 * batch + 1100).select(
            F.lit("d").alias("dataset_id"), F.col("id").cast("string").alias("revision_id"), F.lit(READY).alias("status")
        )
        append_state(rows, log, batch, STEP_PUT)
        append_state(rows.where("revision_id % 1000 < 50").withColumn("status", F.lit(SUCCESS)), log, batch, STEP_UPDATE)
        if batch < 2:
            write_snapshot(spark, log, snapshots, batch)
    files = {}
    for r in spark.read.parquet(f"{snapshots}/as_of=1").select(F.input_file_name().alias("f")).collect():
        files[r["f"]] = files.get(r["f"], 0) + 1
    assert sum(files.values()) == 2100 and max(files.values()) < 200
    assert len([n for n in os.listdir(f"{snapshots}/as_of=1/status=READY") if n.endswith(".parquet")]) > 10
    state = state_as_of(spark, log, snapshots)
    versions = {r["revision_id"]: (r["status"], r["batch"]) for r in state.collect()}
    assert state.count() == len(versions) == 3100
    assert versions["2049"] == (SUCCESS, 2) and versions["2050"] == (READY, 2) and versions["1999"] == (READY, 1)
    plan = state._jdf.queryExecution().executedPlan().toString()
    # a task's rows are dealt out before they are aggregated, which sorts them
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_state_of_wide_rows_is_dealt_out_by_bytes():
    assert sizing.tasks_for(10, 10) == 1
    assert sizing.tasks_for(0, 0) == 1
    assert sizing.tasks_for(10 * sizing.TASK_ROWS + 1, 10) == 11
    assert sizing.tasks_for(10, 3 * sizing.TASK_BYTES) == 3


def test_rows_by_status_are_dealt_out_by_rows(spark, tmp_path, few_rows):
    rows = spark.range(1000).select(
        F.lit("d").alias("dataset_id"), F.col("id").cast("string").alias("revision_id"), F.lit(READY).alias("status")
    )
    write_by_status(rows, str(tmp_path / "by"))
    back = spark.read.parquet(str(tmp_path / "by"))
    assert back.count() == 1000 and len(back.inputFiles()) == 10
