import pytest
from pyspark.sql import functions as F

from tidemark.operators.revisions import (
    asset_descriptor,
    build_revisions,
    clashing_names,
    data_assets,
    explode_assets,
    pack_data_files,
    rekey_assets,
    without_assets,
)
from tidemark.operators.sizing import chunked_lists, short_lists
from tidemark.schemas import LISTING

FILES = [
    ("d", "one", 0, "b.json"),
    ("d", "one", 1, "manifest-old.json"),
    ("d", "one", 2, "a.json"),
    ("d", "one", 3, "manifest-new.json"),
    ("d", "plain", 0, "ü b.json"),
    ("d", "only", 0, "manifest.json"),
]


@pytest.fixture
def listing(spark):
    return spark.createDataFrame(FILES, LISTING)


def built(listing, **kw):
    at = F.lit("2021-06-01 04:00:00").cast("timestamp")
    return {r["revision_id"]: r for r in build_revisions(listing, "b", "in", at, **kw).collect()}


def test_build_revisions(listing):
    got = built(listing)
    assert got["one"]["metadata"] == "manifest-new.json"
    assert got["one"]["n_data_files"] == 2
    keys = [a["key"] for a in got["one"]["data_files"]["heartbeat"]]
    assert keys == ["in/2021/6/1/4/d/one/b.json", "in/2021/6/1/4/d/one/a.json"]
    assert got["one"]["data_files"]["heartbeat"][0].asDict() == {"bucket": "b", "key": keys[0], "version": None}
    assert got["plain"]["metadata"] is None
    assert got["only"]["n_data_files"] == 0 and got["only"]["data_files"] == {}


def test_listed_key_is_kept(listing):
    keyed = listing.withColumn("key", F.concat(F.lit("k/"), "name"))
    assert {r["asset"]["key"] for r in data_assets(keyed, "b").collect()} == {"k/b.json", "k/a.json", "k/ü b.json"}


def test_a_long_revision_keeps_its_count_and_tall_rows(spark):
    long = spark.range(900).select(
        F.lit("d").alias("dataset_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("revision_id"),
        F.col("id").alias("pos"),
        F.concat(F.lit("f"), "id").alias("name"),
    )
    got = built(long, max_rows=100)
    assert len(got) == 601
    assert got["hot"]["n_data_files"] == 300 and got["hot"]["data_files"] is None
    assert len(got["1"]["data_files"]["heartbeat"]) == 1


def test_short_lists_at_the_limit(spark, rows):
    df = spark.range(35).select((F.col("id") / 10).cast("int").alias("k"), F.col("id").alias("o"))
    got = dict(rows(short_lists(df.where("id < 35"), ["k"], ["o"], F.col("o"), 9)))
    assert got == {0: None, 1: None, 2: None, 3: [30, 31, 32, 33, 34]}
    got = dict(rows(short_lists(df, ["k"], ["o"], F.col("o"), 10)))
    assert got[0] == list(range(10))
    assert dict(rows(short_lists(df, ["k"], ["o"], F.col("o"), 5000))) == got
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    try:
        counted = dict(rows(short_lists(df, ["k"], ["o"], F.col("o"), 9)))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert counted == {0: None, 1: None, 2: None, 3: [30, 31, 32, 33, 34]}


def test_chunks_hold_every_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    chunks = chunked_lists(df, ["k"], ["id"], F.col("id"), rows=100).collect()
    assert max(len(c["items"]) for c in chunks) <= 100
    hot = [v for c in sorted((c for c in chunks if c["k"] == "hot"), key=lambda c: c["chunk"]) for v in c["items"]]
    assert hot == list(range(0, 5000, 3))
    assert sum(len(c["items"]) for c in chunks) == 5000


def test_long_list_is_not_an_absent_one(spark, rows):
    kind = "k string, n_data_files long, data_files map<string, array<struct<bucket:string,key:string,version:string>>>"
    df = spark.createDataFrame([("long", 600, None), ("none", 0, None), ("empty", 0, {})], kind)
    assert rows(without_assets(df), "k") == [("empty",), ("none",)]


def test_short_lists_limits_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    text = plan(short_lists(df, ["k"], ["o"], F.col("o"), 9))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("10, Partial")


def test_pack_keeps_names_apart(spark):
    df = spark.createDataFrame(
        [("d", "r", "x", 0, "n0"), ("d", "r", "y", 1, "n1"), ("d", "r", "x", 2, "n2")],
        "dataset_id string, revision_id string, dataset_name string, pos long, name string",
    ).withColumn("asset", asset_descriptor("b", F.col("name")))
    files = pack_data_files(df).first()["data_files"]
    assert {k: [a["key"] for a in v] for k, v in files.items()} == {"x": ["n0", "n2"], "y": ["n1"]}


def test_explode_and_reject(spark, rows):
    a = "struct<bucket:string,key:string,version:string>"
    df = spark.createDataFrame(
        [
            ("two", {"heartbeat": [("b", "k0", None), ("b", "k1", None)]}),
            ("other", {"x": [("b", "k", None)]}),
            ("empty", {"heartbeat": []}),
            ("null", None),
        ],
        f"revision_id string, data_files map<string, array<{a}>>",
    )
    assert rows(explode_assets(df), "revision_id", "pos", "asset.key") == [("two", 0, "k0"), ("two", 1, "k1")]
    assert rows(without_assets(df), "revision_id") == [("empty",), ("null",), ("other",)]


def test_rekey(spark):
    df = spark.range(1).select(F.array(asset_descriptor("b", F.lit("x.json")), asset_descriptor("b", F.lit("y"))).alias("a"))
    got = df.select(rekey_assets(F.col("a"), lambda a: a["key"].endswith(".json"), lambda a: F.lit("x.csv")).alias("a"))
    assert [x["key"] for x in got.first()["a"]] == ["x.csv", "y"]
    every = df.select(rekey_assets(F.col("a"), None, lambda a: F.upper(a["key"])).alias("a"))
    assert [x["key"] for x in every.first()["a"]] == ["X.JSON", "Y"]


def test_clash(spark, rows):
    df = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "b"), ("s", "a")], "revision_id string, stem string")
    assert rows(clashing_names(df, ["revision_id", "stem"])) == [("r", "a", 2)]
