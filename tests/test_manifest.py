"""Named outputs through a manifest: parts, replacement, replays, odd values."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_feed import CLOCK, ENVELOPES, listing, make_feed, raw
from tidemark.plans.feed import feed_outputs, run_batch
from tidemark.sinks.manifest import live_parts, outputs, read_outputs, write_manifest_csv
from tidemark.sources.assets import common_folder

NAMES = "asset string, target string"
SCHEMA = "id BIGINT, t STRING"


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id long, t string, asset string").repartition(2)


def held(spark, root, manifest, until=None):
    parts = live_parts(spark, manifest, ["asset"], until)
    return sorted((r["target"], r["id"], r["t"]) for r in read_outputs(spark, parts, root, SCHEMA).collect())


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "root"), str(tmp_path / "manifest")


def test_outputs_and_replacement(spark, places):
    root, manifest = places
    names = spark.createDataFrame(
        [("ü a=1/b", "x/ü.csv"), (None, "x/none.csv"), ("empty", "x/empty.csv"), ("b", "x/b.csv")], NAMES
    )
    odd = 'two\nlines, "quoted"'
    first = frame(spark, (1, odd, "ü a=1/b"), (2, "p", "ü a=1/b"), (3, "n", None), (4, "old", "b"), (5, "old", "b"))
    for _ in range(2):
        write_manifest_csv(first, root, "out/batch=0", names, ["asset"], manifest, 0)
    before = [("x/b.csv", 4, "old"), ("x/b.csv", 5, "old"), ("x/none.csv", 3, "n"), ("x/ü.csv", 1, odd), ("x/ü.csv", 2, "p")]
    assert held(spark, root, manifest) == before
    told = {r["target"]: r for r in outputs(live_parts(spark, manifest, ["asset"])).collect()}
    assert {k: v["n_rows"] for k, v in told.items()} == {"x/ü.csv": 2, "x/none.csv": 1, "x/empty.csv": 0, "x/b.csv": 2}
    assert (told["x/empty.csv"]["n_parts"], told["x/empty.csv"]["bytes"]) == (0, 0)

    write_manifest_csv(frame(spark, (9, "new", "b")), root, "out/batch=1", names.where("asset = 'b'"), ["asset"], manifest, 1)
    assert held(spark, root, manifest) == [("x/b.csv", 9, "new"), *before[2:]]
    assert held(spark, root, manifest, until=0) == before


def test_a_batch_that_died_is_not_seen(spark, places):
    root, manifest = places
    names = spark.createDataFrame([("a", "a.csv")], NAMES)
    write_manifest_csv(frame(spark, (1, "x", "a")), root, "out/batch=0", names, ["asset"], manifest, 0)
    write_manifest_csv(frame(spark, (2, "y", "a")), root, "out/batch=1", names, ["asset"], manifest, 1)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{manifest}/batch=1/_SUCCESS")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, False)
    assert held(spark, root, manifest) == [("a.csv", 1, "x")]


def test_many_parts_are_read_by_folder(spark, places, monkeypatch):
    import tidemark.sinks.manifest as module

    root, manifest = places
    names = spark.createDataFrame([("a", "a.csv"), ("b", "b.csv")], NAMES)
    for batch, t in ((0, "old"), (1, "new")):
        write_manifest_csv(frame(spark, (1, t, "a"), (2, t, "b")), root, f"out/batch={batch}", names, ["asset"], manifest, batch)
    monkeypatch.setattr(module, "nameable_files", lambda files: None)
    assert held(spark, root, manifest) == [("a.csv", 1, "new"), ("b.csv", 2, "new")]


def test_nothing_published(spark, places):
    root, manifest = places
    assert held(spark, root, manifest) == []
    names = spark.createDataFrame([], NAMES)
    write_manifest_csv(frame(spark, (1, "x", "a")).limit(0), root, "out/batch=0", names, ["asset"], manifest, 0)
    assert held(spark, root, manifest) == []


def test_one_name_for_two_is_refused(spark, places):
    root, manifest = places
    names = spark.createDataFrame([("a", "x.csv"), ("b", "x.csv")], NAMES)
    with pytest.raises(ValueError):
        write_manifest_csv(frame(spark, (1, "x", "a")), root, "out/batch=0", names, ["asset"], manifest, 0)


def test_feed_publishes_its_outputs(spark, tmp_path):
    feed = replace(make_feed(tmp_path), named=False)
    run_batch(feed, raw(spark, *ENVELOPES), listing(feed), 0, CLOCK)
    parts = feed_outputs(feed, spark)
    back = read_outputs(spark, parts, feed.root, "timestampssincelastrevision STRING")
    got = back.groupBy("target").agg(F.sort_array(F.collect_list(F.coalesce("timestampssincelastrevision", F.lit("")))))
    assert {r[0].removeprefix("heartbeat_csv/2021/6/22/0/"): r[1] for r in got.collect()} == {
        "d1/r1/a.v1.csv": ['["1","2"]'],
        "d1/r1/a.v2.csv": ["", '["3"]'],
        "d1/r2/c.csv": ['["x,y"]'],
    }
    rows = {r["target"].rpartition("/")[2]: r["n_rows"] for r in outputs(parts).collect()}
    assert rows == {"a.v1.csv": 1, "a.v2.csv": 2, "b.csv": 0, "c.csv": 1}


@pytest.mark.parametrize(
    ("keys", "want"),
    [
        (["in/a/1/x.json", "in/a/2/y.json"], ["/r/in/a"]),
        (["in/ab/x.json", "in/ac/y.json"], ["/r/in"]),
        (["in/x[1]/a.json", "in/x[1]/b.json"], ["/r/in"]),
        (["a.json", "b/c.json"], None),
        ([], None),
    ],
)
def test_common_folder(spark, keys, want):
    assert common_folder(spark.createDataFrame([(k,) for k in keys], "key string"), "/r") == want
