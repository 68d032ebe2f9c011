"""Snapshots, quarantine, file index and long lists: against the plain log, and in the feed."""

import json
import random
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tests.test_feed import CLOCK, ENVELOPES, listing, make_feed, raw, state
from tidemark.operators.quarantine import pending_redrive, quarantined, read_quarantine
from tidemark.operators.sizing import numbered
from tidemark.operators.snapshots import drop_snapshots, numbered_folders, state_as_of, write_snapshot
from tidemark.operators.state import STEP_PUT, STEP_UPDATE, append_state, current_state, read_state_log
from tidemark.plans.feed import feed_files, feed_state, run_batch
from tidemark.sources.assets import list_requested
from tidemark.sources.file_index import fixed_prefix, grow_index, indexed_listing, list_layout, read_index


def versions(df):
    return sorted((r["dataset_id"], r["revision_id"], r["status"], r["batch"], r["step"]) for r in df.collect())


def test_snapshot_and_tail_equal_the_whole_log(spark, tmp_path):
    log, snapshots = str(tmp_path / "log"), str(tmp_path / "snapshots")

    def one(batch, seed):
        drop_snapshots(spark, snapshots, batch)
        picks = random.Random(seed)
        for step, status in ((STEP_PUT, "READY"), (STEP_UPDATE, "SUCCESS")):
            keys = {(picks.choice("ab"), str(picks.randrange(9))) for _ in range(4)}
            rows = spark.createDataFrame([(*k, status) for k in sorted(keys)], "dataset_id string, revision_id string, status string")
            append_state(rows, log, batch, step)
        if batch in (1, 3):
            write_snapshot(spark, log, snapshots, batch)

    for batch in (0, 1, 2, 3):
        one(batch, batch)
    one(3, 33)  # the snapshot's own batch again, with other rows
    one(4, 4)
    whole = read_state_log(spark, log)
    for as_of in (None, (4, STEP_PUT), (3, STEP_UPDATE), (3, STEP_PUT), (1, STEP_PUT), (0, STEP_UPDATE)):
        assert versions(state_as_of(spark, log, snapshots, as_of)) == versions(current_state(whole, as_of)), as_of
    ready = versions(current_state(whole).where("status = 'READY' AND dataset_id = 'a'"))
    assert versions(state_as_of(spark, log, snapshots, None, "READY", ["a"])) == ready
    # batches before the snapshot are not read, and of it one status folder
    files = state_as_of(spark, log, snapshots, None, "READY").inputFiles()
    assert all("/log/batch=4/" in f or "/as_of=3/status=READY/" in f for f in files if "/log/" in f or "status=R" in f)
    assert not any(f"/batch={n}/" in f for f in files for n in (0, 1, 2, 3))
    # one that was being written when its run died doesn't count
    (tmp_path / "snapshots" / "as_of=3" / "_SUCCESS").unlink()
    assert numbered_folders(spark, snapshots, "as_of", committed=True) == [1]
    assert versions(state_as_of(spark, log, snapshots)) == versions(current_state(whole))
    assert state_as_of(spark, str(tmp_path / "none"), snapshots + "x").isEmpty()


def test_places_are_dense_with_a_hot_key_and_ties(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("k"),
        (F.col("id") % 700).alias("o"), "id",
    )
    placed = numbered(rows, ["k"], ["o"], str(tmp_path / "ranges")).collect()
    groups = {}
    for r in placed:
        groups.setdefault(r["k"], []).append((r["place"], r["o"]))
    assert sum(map(len, groups.values())) == 3000
    for found in groups.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert [o for _, o in found] == sorted(o for _, o in found)


def test_reasons_and_copies(spark):
    good = json.dumps({"InitialInit": {"data_set_id": "d", "RevisionIds": "r"}})
    values = ["nonsense", "nonsense", "{}", '{"Records":[]}', '{"Records":[{"body":null},{"body":"{x"}]}', good, None,
              '{"Records":[{"body":"{\\"resources\\":[]}"},{"body":"{\\"resources\\":[\\"d\\"]}"}]}']
    found = quarantined(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    told = sorted((r["value"] or "", r["record_pos"] or 0, r["reason"], r["copies"]) for r in found if r["value"])
    assert told == sorted([
        ("nonsense", 0, "envelope is not JSON", 2),
        ("{}", 0, "envelope has no records", 1),
        (values[3], 0, "envelope has no records", 1),
        (values[4], 0, "record has no body", 1),
        (values[4], 1, "body is not JSON", 1),
        (values[7], 0, "no data set", 1),
        (values[7], 1, "no revision", 1),
    ])


def test_feed_with_long_lists_redrive_and_attempts(spark, tmp_path):
    feed = replace(make_feed(tmp_path), list_rows=1, max_attempts=3, snapshot_every=2, inputs="in")
    broken = ENVELOPES[0][:-1]
    lost = json.dumps({"InitialInit": {"data_set_id": "d9", "RevisionIds": "r9"}})
    run_batch(feed, raw(spark, broken, lost), listing(feed), 0, CLOCK)
    assert feed_files(feed, spark).isEmpty() if (tmp_path / "work" / "csv_assets").exists() else True
    assert [r["value"] for r in read_quarantine(spark, feed.quarantine).collect()] == [broken]

    def repair(rows):
        return rows.withColumn("value", F.concat("value", F.lit("}")))

    for _ in range(2):
        run_batch(feed, raw(spark, ENVELOPES[2]), listing(feed), 1, CLOCK, repair)
    assert pending_redrive(spark, feed.quarantine, feed.redriven, 2).isEmpty()
    got = state(spark, feed)
    assert {k[1]: v["status"] for k, v in got.items()} == {"r1": "SUCCESS", "r2": "SUCCESS", "r3": "READY", "r9": "READY"}
    assert got[("d1", "r1")]["data_files"] is None and got[("d1", "r1")]["n_csv_files"] == 2
    keys = sorted(r["csv_key"] for r in feed_files(feed, spark).collect())
    assert [k.rpartition("/")[2] for k in keys] == ["a.v1.csv", "a.v2.csv", "b.csv", "c.csv"]
    lines = spark.read.parquet(feed.folder("corrupt_lines", 1)).collect()
    assert sorted((r["revision_id"], r["line"]) for r in lines) == [("r1", "{broken"), ("r2", "{broken")]
    assert numbered_folders(spark, feed.snapshots, "as_of", committed=True) == [1]
    run_batch(feed, raw(spark, lost), listing(feed), 2, CLOCK)  # asked anew: attempts start again
    # the file comes late and is found by the next attempt
    late = tmp_path / "root" / "in" / "2021" / "6" / "21" / "16" / "d9" / "r9"
    late.mkdir(parents=True)
    (late / "x.json").write_text('{"timestampssincelastrevision":["9"]}\n')
    run_batch(feed, raw(spark, "{}"), listing(feed), 3, datetime(2021, 6, 22, 1))
    assert {k[1]: (v["status"], v["attempts"]) for k, v in state(spark, feed).items()} == {
        "r1": ("SUCCESS", 1), "r2": ("SUCCESS", 1), "r3": ("REJECTED", 3), "r9": ("SUCCESS", 2),
    }
    assert feed_state(feed, spark, "READY").isEmpty()


def test_file_index(spark, tmp_path):
    root, index = str(tmp_path / "root"), str(tmp_path / "index")
    layout = "in/*/{dataset_id}/{revision_id}"

    def put(key, text):
        path = tmp_path / "root" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    assert fixed_prefix(layout) == "in" and list_layout(spark, root, layout).isEmpty()
    put("in/1/d*[x]/r?1/a.json", "1")
    put("in/1/d/r{2}/sub/b.json", "22")
    put("in/loose.json", "3")
    put("out/1/d*[x]/r?1/a.json", "an earlier output")
    grow_index(spark, root, layout, index, 0)
    put("in/2/d/r{2}/c.json", "333")
    put("in/1/d*[x]/r?1/a.json", "longer now")
    for _ in range(2):
        grow_index(spark, root, layout, index, 1)
    sizes = sorted((r["batch"], r["key"]) for r in spark.read.parquet(index).collect())
    assert sizes == [
        (0, "in/1/d*[x]/r?1/a.json"), (0, "in/1/d/r{2}/sub/b.json"), (1, "in/1/d*[x]/r?1/a.json"), (1, "in/2/d/r{2}/c.json"),
    ]
    assert read_index(spark, index).count() == 3
    asked = spark.createDataFrame([("d*[x]", "r?1"), ("d", "none")], "dataset_id string, revision_id string")
    found = indexed_listing(asked, index).collect()
    assert [(r["key"], r["bytes"]) for r in found] == [("in/1/d*[x]/r?1/a.json", 10)]
    # by look-up an id with pattern signs is found too, and no output is taken for an input
    both = asked.union(spark.createDataFrame([("d", "r{2}")], asked.schema))
    for limit in (0, 1, 1000):
        looked = list_requested(both, root, layout, limit).select("key").collect()
        assert sorted(r["key"] for r in looked if not r["key"].count("/sub/")) == ["in/1/d*[x]/r?1/a.json", "in/2/d/r{2}/c.json"]
