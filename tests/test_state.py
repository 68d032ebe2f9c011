from pyspark.sql import functions as F

from tidemark.operators.latest import earliest_by, latest_by
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

ROW = "dataset_id string, revision_id string, status string, metadata string"


def state(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def test_put_replaces_whole_rows(spark, rows):
    old = state(spark, ("d", "1", "SUCCESS", "m1"), ("d", "2", "READY", "m2"))
    new = state(spark, ("d", "1", "READY", None), ("e", "1", "READY", "m3"))
    assert rows(put_revisions(old, new)) == [
        ("d", "1", "READY", None),
        ("d", "2", "READY", "m2"),
        ("e", "1", "READY", "m3"),
    ]


def test_update_sets_only_named_columns_even_to_null(spark, rows):
    old = state(spark, ("d", "1", "READY", "m1"), ("d", "2", "READY", "m2"))
    changes = state(spark, ("d", "1", "SUCCESS", None))
    assert rows(update_revisions(old, changes, ["status"])) == [("d", "1", "SUCCESS", "m1"), ("d", "2", "READY", "m2")]
    assert rows(update_revisions(old, changes, ["status", "metadata"]))[0] == ("d", "1", "SUCCESS", None)


def test_log_replay_and_as_of(spark, tmp_path, rows):
    log = str(tmp_path / "log")
    append_state(state(spark, ("d", "1", "READY", "m"), ("d", "2", "READY", "m")), log, 0, STEP_PUT)
    for _ in range(2):
        append_state(state(spark, ("d", "1", "SUCCESS", "m")), log, 0, STEP_UPDATE)
    append_state(state(spark, ("d", "2", "SUCCESS", "n")), log, 1, STEP_UPDATE)

    def now(as_of=None):
        return rows(current_state(read_state_log(spark, log), as_of), "revision_id", "status", "metadata")

    assert now() == [("1", "SUCCESS", "m"), ("2", "SUCCESS", "n")]
    assert now((0, STEP_PUT)) == [("1", "READY", "m"), ("2", "READY", "m")]
    assert now((0, STEP_UPDATE)) == [("1", "SUCCESS", "m"), ("2", "READY", "m")]


def test_as_of_prunes_folders_and_key_filter_reaches_the_scan(spark, tmp_path, plan):
    log = str(tmp_path / "log")
    append_state(state(spark, ("d", "1", "READY", "m")), log, 0, STEP_PUT)
    latest = current_state(read_state_log(spark, log), (0, STEP_PUT))
    text = plan(ready_revisions(latest, ["d"]))
    assert "EqualTo(dataset_id,d)" in text
    assert "EqualTo(status,READY)" not in text
    assert "PartitionFilters: [isnotnull(batch" in text or "PartitionFilters: [(" in text


def test_ready_revisions_sees_only_the_latest(spark, rows):
    log = state(spark, ("d", "1", "READY", "a"), ("d", "1", "SUCCESS", "b"), ("d", "2", "READY", "a"), ("e", "1", "READY", "a"))
    latest = latest_by(log, ["dataset_id", "revision_id"], ["metadata"])
    assert rows(ready_revisions(latest, ["d"]), "revision_id") == [("2",)]
    assert rows(ready_revisions(latest), "dataset_id", "revision_id") == [("d", "2"), ("e", "1")]


def test_latest_and_earliest_on_a_hot_key(spark, rows, plan):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = latest_by(df, ["k"], ["v"])
    assert latest.count() == 2001
    assert rows(latest.where("k = -1")) == [(-1, 2997)]
    assert rows(earliest_by(df, ["k"], ["v"]).where("k = -1")) == [(-1, 0)]
    assert "partial_max_by" in plan(latest)


def test_status_folders_are_pruned(spark, tmp_path, rows, plan):
    path = str(tmp_path / "s")
    write_by_status(state(spark, ("d", "1", "READY", "a"), ("d", "2", "SUCCESS", "a")), path)
    ready = revisions_by_status(spark.read.parquet(path), "READY")
    assert rows(ready, "revision_id") == [(1,)] or rows(ready, "revision_id") == [("1",)]
    assert "PartitionFilters: [isnotnull(status" in plan(ready)


def test_expiry(spark, rows):
    df = spark.createDataFrame([("past", 999), ("now", 1000), ("future", 1001), ("none", None)], "k string, time_to_exist long")
    assert rows(drop_expired(df, F.timestamp_seconds(F.lit(1000))), "k") == [("future",), ("none",)]
