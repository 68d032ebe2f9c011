import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.messages import outbound_messages, rows_that_may_fit, split_oversize
from tidemark.operators.revisions import asset_descriptor
from tidemark.sinks.messages import ordered_by_group, write_messages


def assets(spark, data):
    """(revision, pos, name) as asset rows."""
    df = spark.createDataFrame(data, "revision_id string, pos long, name string")
    return df.select(
        F.lit("d").alias("dataset_id"),
        "revision_id",
        "pos",
        "name",
        asset_descriptor("b", F.concat("name", F.lit(".json"))).alias("asset"),
        F.concat("name", F.lit(".csv")).alias("csv_key"),
    )


def keys(message):
    return [a["key"] for a in json.loads(message)["dataFilesMap"]["heartbeat"]]


def test_one_message_per_revision(spark):
    got = outbound_messages(assets(spark, [("r", 1, "y"), ("r", 0, "z"), ("s", 0, "q")])).collect()
    by_revision = {r["revision_id"]: r["message"] for r in got}
    assert keys(by_revision["r"]) == ["z.csv", "y.csv"]
    assert json.loads(by_revision["s"]) == {
        "dataset_id": "d",
        "revision_id": "s",
        "dataFilesMap": {"heartbeat": [{"bucket": "b", "key": "q.csv", "version": None}]},
    }


def test_progress_messages(spark):
    got = outbound_messages(assets(spark, [("r", 0, "x"), ("r", 1, "y"), ("r", 2, "z")]), mode="progress")
    by_pos = {r["pos"]: keys(r["message"]) for r in got.collect()}
    assert by_pos == {
        0: ["x.csv", "y.json", "z.json"],
        1: ["x.csv", "y.csv", "z.json"],
        2: ["x.csv", "y.csv", "z.csv"],
    }
    with pytest.raises(ValueError):
        outbound_messages(assets(spark, [("r", 0, "x")]), mode="other")


def test_size_limit_is_in_bytes_and_inclusive(spark, rows):
    exact = "é" * 1000 + "x" * 48
    df = spark.createDataFrame([("at", exact), ("above", exact + "x"), ("below", exact[:-1])], "k string, message string")
    sent, rejected = split_oversize(df)
    assert rows(sent, "k") == [("at",), ("below",)]
    assert rows(rejected, "k") == [("above",)]


@pytest.mark.parametrize("mode", ["revision", "progress"])
def test_hot_revision_is_rejected_without_a_list(spark, mode):
    n = rows_that_may_fit(2048)
    data = [("hot", i, f"f{i}") for i in range(1000)] + [("edge", i, "") for i in range(n)] + [("ok", 0, "x")]
    messages = outbound_messages(assets(spark, data), mode=mode)
    sent, rejected = split_oversize(messages)
    count = {"revision": (1, 2), "progress": (1, 1000 + n)}[mode]
    assert (sent.count(), rejected.count()) == count
    assert messages.where("revision_id = 'hot' AND message IS NOT NULL").count() == 0
    assert messages.where("revision_id = 'edge' AND message IS NULL").count() == 0


def test_no_list_longer_than_the_bound_can_fit(spark):
    n = rows_that_may_fit(2048)
    message = {"dataset_id": "", "revision_id": "", "dataFilesMap": {"heartbeat": [{"bucket": "", "key": "", "version": None}] * (n + 1)}}
    assert len(json.dumps(message, separators=(",", ":"))) > 2048


def test_order_within_a_hot_group(spark, tmp_path, plan):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).cast("string").alias("dataset_id"),
        (1999 - F.col("id")).alias("pos"),
        F.lit("m").alias("message"),
    )
    path = str(tmp_path / "m")
    write_messages(df, path, order=["pos"])
    back = spark.read.schema("dataset_id string, pos long, message string").json(path)
    read = back.select("dataset_id", "pos", "_metadata.file_path", F.monotonically_increasing_id().alias("at")).collect()
    assert len(read) == 2000
    seen = {}
    for row in sorted(read, key=lambda r: (r["file_path"], r["at"])):
        assert seen.get(row["dataset_id"], -1) < row["pos"]
        seen[row["dataset_id"]] = row["pos"]
    assert "rangepartitioning(dataset_id" in plan(ordered_by_group(df, "dataset_id", ["pos"]))
