"""The whole feed: batch, replay after a crash, rejects, stream against batch."""

import json
from dataclasses import replace
from datetime import datetime

import pytest

import tidemark.plans.feed as plans
from tidemark.plans.feed import Feed, feed_state, run_batch
from tidemark.schemas import LISTING
from tidemark.sources.assets import list_assets, list_requested
from tidemark.sources.events import stream_events
from tidemark.streaming.dedup import dedup_events_stream
from tidemark.streaming.feed import run_stream

CLOCK = datetime(2021, 6, 22, 0, 48)
ASSETS = {
    ("d1", "r1"): {
        "a.v1.json": ['{"timestampssincelastrevision":["1","2"]}', "{broken"],
        "a.v2.json": ['{"timestampssincelastrevision":["3"]}', '{"other":1}'],
        "manifest.json": ["{}"],
    },
    ("d1", "r2"): {"b.json": ["{broken"], "empty.json": [], "c.json": ['{"timestampssincelastrevision":["x,y"]}']},
    ("d2", "r3"): {"manifest.json": ["{}"]},
    ("d2", "r4"): {"ü d.json": ['{"timestampssincelastrevision":[]}']},
}


def body(dataset, *revisions, source="feed"):
    return json.dumps(
        {"source": source, "detail-type": "published", "resources": [dataset], "detail": {"RevisionIds": revisions}}
    )


ENVELOPES = [
    json.dumps({"Records": [{"body": body("d1", "r1")}, {"body": body("d1", "r1", "r2")}]}),
    json.dumps({"Records": [{"body": body("d2", "r4", source="else")}]}),
    json.dumps({"InitialInit": {"data_set_id": "d2", "RevisionIds": "r3"}}),
]


def make_feed(tmp_path):
    for (dataset, revision), files in ASSETS.items():
        folder = tmp_path / "root" / "in" / "2021" / "6" / "21" / "16" / dataset / revision
        folder.mkdir(parents=True)
        for name, lines in files.items():
            (folder / name).write_text("".join(f"{line}\n" for line in lines))
    return Feed(str(tmp_path / "root"), str(tmp_path / "work"), "b", ("feed",), ("published",), named=True)


@pytest.fixture
def feed(tmp_path):
    return make_feed(tmp_path)


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    """Outcome of one run that nothing disturbed."""
    feed = make_feed(tmp_path_factory.mktemp("undisturbed"))
    run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    return outcome(spark, feed)


def listing(feed):
    return lambda requested: list_requested(requested, feed.root, "in/*/*/*/*/{dataset_id}/{revision_id}")


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values or ENVELOPES], "value string")


def csv_lines(feed):
    """Lines of every CSV below its revision, keyed by path below the hour."""
    import pathlib

    top = pathlib.Path(feed.root) / feed.csv_prefix
    return {
        str(p.relative_to(top)): sorted(p.read_text().splitlines())
        for p in top.rglob("*.csv")
        if p.is_file()
    }


def state(spark, feed):
    return {(r["dataset_id"], r["revision_id"]): r for r in feed_state(feed, spark).collect()}


def messages(spark, feed):
    rows = spark.read.schema("dataset_id string, revision_id string, message string").json(f"{feed.work}/messages")
    return sorted(r["message"] for r in rows.collect())


def outcome(spark, feed):
    return csv_lines(feed), {k: v["status"] for k, v in state(spark, feed).items()}, messages(spark, feed)


def test_batch(spark, feed):
    counts = run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    assert counts == {"n_lines": 6, "n_corrupt": 2}
    header = "timestampssincelastrevision"
    assert csv_lines(feed) == {
        "2021/6/22/0/d1/r1/a.v1.csv": sorted([header, '"[""1"",""2""]"']),
        "2021/6/22/0/d1/r1/a.v2.csv": sorted([header, '"[""3""]"', '""']),
        "2021/6/22/0/d1/r2/b.csv": [header],
        "2021/6/22/0/d1/r2/c.csv": sorted([header, '"[""x,y""]"']),
    }
    got = state(spark, feed)
    assert {k: v["status"] for k, v in got.items()} == {
        ("d1", "r1"): "SUCCESS",
        ("d1", "r2"): "SUCCESS",
        ("d2", "r3"): "READY",
    }
    first = got[("d1", "r1")]
    assert first["metadata"] == "manifest.json" and first["n_data_files"] == 2
    assert first["export_time_stamp"] == "2021-06-22 00:48:00.000000"
    assert [a["key"] for a in first["data_files"]["heartbeat"]] == [
        "in/2021/6/21/16/d1/r1/a.v1.json",
        "in/2021/6/21/16/d1/r1/a.v2.json",
    ]
    assert [a["key"] for a in first["data_files_csv"]] == [
        "heartbeat_csv/2021/6/22/0/d1/r1/a.v1.csv",
        "heartbeat_csv/2021/6/22/0/d1/r1/a.v2.csv",
    ]
    sent = [json.loads(m) for m in messages(spark, feed)]
    assert [(m["dataset_id"], m["revision_id"]) for m in sent] == [("d1", "r1"), ("d1", "r2")]
    assert [a["key"] for a in sent[1]["dataFilesMap"]["heartbeat"]] == [
        "heartbeat_csv/2021/6/22/0/d1/r2/b.csv",
        "heartbeat_csv/2021/6/22/0/d1/r2/c.csv",
    ]
    rejects = spark.read.parquet(f"{feed.work}/rejects").select("revision_id", "reason").collect()
    assert [tuple(r) for r in rejects] == [("r3", "no data files")]


def test_repeating_a_batch_changes_nothing(spark, feed, undisturbed):
    run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    assert outcome(spark, feed) == undisturbed


@pytest.mark.parametrize("step", ["name_folders", "append_state", "write_messages"])
def test_repeating_after_a_crash(spark, feed, undisturbed, monkeypatch, step):
    real, calls = getattr(plans, step), []

    def crash(*args, **kwargs):
        calls.append(step)
        if step != "append_state" or len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(plans, step, crash)
    with pytest.raises(RuntimeError):
        run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    monkeypatch.setattr(plans, step, real)
    run_batch(feed, raw(spark), listing(feed), 0, CLOCK)
    assert outcome(spark, feed) == undisturbed


def test_later_batches_take_only_what_is_ready(spark, feed):
    run_batch(feed, raw(spark, ENVELOPES[0]), listing(feed), 0, CLOCK)
    counts = run_batch(feed, raw(spark, ENVELOPES[1]), listing(feed), 1, CLOCK)
    assert counts == {"n_lines": 0, "n_corrupt": 0}
    again = json.dumps({"InitialInit": {"data_set_id": "d2", "RevisionIds": "r4"}})
    counts = run_batch(feed, raw(spark, again), listing(feed), 2, CLOCK)
    assert counts["n_lines"] == 1
    assert state(spark, feed)[("d2", "r4")]["batch"] == 2
    assert "2021/6/22/0/d2/r4/ü d.csv" in csv_lines(feed)


def test_rejects_keep_their_revision_ready(spark, feed, tmp_path):
    clash = tmp_path / "root" / "in" / "2021" / "6" / "21" / "16" / "d1" / "r2" / "c.txt"
    clash.write_text("{}\n")
    listed = list_assets(spark, feed.root).select("dataset_id", "revision_id", "pos", "name", "key")
    gone = spark.createDataFrame(
        [("d2", "r4", None, "gone.json", "in/nowhere/gone.json")], listed.schema
    )
    asked = raw(spark, *ENVELOPES, json.dumps({"InitialInit": {"data_set_id": "d2", "RevisionIds": "r4"}}))
    run_batch(feed, asked, lambda requested: listed.unionByName(gone), 0, CLOCK)
    rejects = spark.read.parquet(f"{feed.work}/rejects").select("revision_id", "reason").collect()
    assert sorted(tuple(r) for r in rejects) == [
        ("r2", "name clash"),
        ("r3", "no data files"),
        ("r4", "missing or empty file"),
    ]
    assert {k[1]: v["status"] for k, v in state(spark, feed).items()} == {
        "r1": "SUCCESS",
        "r2": "READY",
        "r3": "READY",
        "r4": "READY",
    }
    assert all("/r1/" in path for path in csv_lines(feed))


def test_listing_without_keys_composes_them(spark, feed):
    flat = list_assets(spark, feed.root).select("dataset_id", "revision_id", "name").collect()
    rows = [(r["dataset_id"], r["revision_id"], i, r["name"]) for i, r in enumerate(flat)]
    rows.append(("d1", "r2", 99, "empty.json"))
    at = datetime(2021, 6, 21, 16)
    listed = spark.createDataFrame(rows, LISTING)
    run_batch(replace(feed, prefix="in"), raw(spark), lambda requested: listed, 0, at)
    got = state(spark, feed)
    assert got[("d1", "r1")]["status"] == "SUCCESS"
    assert got[("d1", "r2")]["status"] == "READY"
    rejects = spark.read.parquet(f"{feed.work}/rejects").where("revision_id = 'r2'").collect()
    assert [r["reason"] for r in rejects] == ["missing or empty file"]


def test_partitioned_output_and_progress_messages(spark, feed):
    run_batch(replace(feed, named=False, mode="progress"), raw(spark), listing(feed), 0, CLOCK)
    got = [json.loads(m)["dataFilesMap"]["heartbeat"] for m in messages(spark, feed)]
    assert len(got) == 4
    done = [sum(a["key"] is None or a["key"].startswith("heartbeat_csv/batch=0/") for a in m) for m in got]
    assert sorted(done) == [1, 1, 2, 2]
    assert state(spark, feed)[("d1", "r2")]["status"] == "SUCCESS"


def test_stream_equals_batch(spark, feed, undisturbed, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    streamed = replace(feed, work=str(tmp_path / "streamed"), csv_prefix="streamed")

    def run():
        query = run_stream(streamed, stream_events(spark, str(queue), 1), listing(feed), str(tmp_path / "cp"))
        query.awaitTermination()

    for i, envelope in enumerate(ENVELOPES):
        (queue / f"{i}.txt").write_text(envelope + "\n")
        if i:
            run()
    run()
    batch, stream = undisturbed, outcome(spark, streamed)

    def below_hour(lines):
        return {path.split("/", 4)[-1]: held for path, held in lines.items()}

    assert below_hour(stream[0]) == below_hour(batch[0])
    assert stream[1] == batch[1]
    assert [json.loads(m)["revision_id"] for m in stream[2]] == [json.loads(m)["revision_id"] for m in batch[2]]
    run()
    assert outcome(spark, streamed) == stream


def test_stream_drops_a_repeated_envelope(spark, feed, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()

    def run():
        events = stream_events(spark, str(queue))
        run_stream(feed, events, listing(feed), str(tmp_path / "cp"), dedup_span="1 hour").awaitTermination()

    (queue / "0.txt").write_text(ENVELOPES[0] + "\n" + ENVELOPES[0] + "\n")
    run()
    (queue / "1.txt").write_text(ENVELOPES[0] + "\n" + ENVELOPES[2] + "\n")
    run()
    got = state(spark, feed)
    assert {k[1]: (v["status"], v["batch"]) for k, v in got.items() if k[1] != "r3"} == {
        "r1": ("SUCCESS", 0),
        "r2": ("SUCCESS", 0),
    }
    assert got[("d2", "r3")]["status"] == "READY"
    assert len(messages(spark, feed)) == 2


def test_dedup_stream_span(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "g string, body string, ts timestamp"

    def drop(*data):
        spark.createDataFrame([(g, b, datetime(2024, 1, 1, h)) for g, b, h in data], schema).coalesce(1).write.mode(
            "append"
        ).parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        dedup_events_stream(events, ["g"], "body", "ts", "2 hours").writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start(sink).awaitTermination()

    drop(("a", "x", 1), ("a", "x", 1), ("b", "x", 1))
    drop(("a", "x", 2))
    drop(("a", "y", 9))
    drop(("a", "x", 10))
    got = sorted((r["g"], r["body"], r["ts"].hour) for r in spark.read.schema(schema).parquet(sink).collect())
    assert got == [("a", "x", 1), ("a", "x", 10), ("a", "y", 9), ("b", "x", 1)]
