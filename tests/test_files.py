import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.mapping import HEARTBEAT_MAPPING, apply_mapping
from tidemark.operators.sizing import broadcast_if_small
from tidemark.sinks.csv import CSV_OPTIONS, write_csv, write_named_csv
from tidemark.sources.assets import list_assets, list_files, list_requested, locate_assets, scan_assets, scan_folders
from tidemark.sources.events import read_events
from tidemark.sources.json_lines import corrupt_summary, read_json_lines, read_variant_lines

LINES = [
    '{"timestampssincelastrevision":["1","2"],"extra":1}',
    '{"timestampssincelastrevision":[]}',
    '{"timestampssincelastrevision":null}',
    '{"other":1}',
    '{"timestampssincelastrevision":["a,b","say \\"hi\\""]}',
    '{"timestampssincelastrevision":"text"}',
    "{broken",
]


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


@pytest.fixture
def heartbeat(tmp_path):
    put(tmp_path, "a.json", *LINES)
    put(tmp_path, "empty.json")
    return str(tmp_path)


def test_json_lines(spark, heartbeat):
    df = read_json_lines(spark, heartbeat)
    got = {(tuple(r[0]) if r[0] is not None else None, r[1]) for r in df.collect()}
    assert got == {
        (("1", "2"), None),
        ((), None),
        (None, None),
        (("a,b", 'say "hi"'), None),
        (None, LINES[5]),
        (None, LINES[6]),
    }
    assert corrupt_summary(df).first().asDict() == {"n_lines": 7, "n_corrupt": 2}
    assert read_json_lines(spark, [heartbeat], keep_corrupt=False).columns == ["timestampssincelastrevision"]


def test_only_mapped_fields_are_parsed(spark, heartbeat, plan):
    schema = T.StructType.fromDDL("timestampssincelastrevision array<string>, extra int")
    df = apply_mapping(read_json_lines(spark, heartbeat, schema, keep_corrupt=False))
    assert "ReadSchema: struct<timestampssincelastrevision:array<string>>" in plan(df)


def test_variant_keeps_types(spark, tmp_path, rows):
    put(tmp_path, "v.json", '{"x":1}', '{"x":"one"}', '{"x":[1]}')
    df = read_variant_lines(spark, str(tmp_path)).select(F.schema_of_variant(F.variant_get("v", "$.x", "variant")))
    assert rows(df) == [("ARRAY<BIGINT>",), ("BIGINT",), ("STRING",)]


def test_mapping(spark, heartbeat, rows):
    lines = read_json_lines(spark, heartbeat).where("_corrupt_record IS NULL")
    got = apply_mapping(lines)
    assert got.columns == ["timestampssincelastrevision"]
    assert rows(got) == [('["1","2"]',), ('["a,b","say \\"hi\\""]',), ("[]",), (None,), (None,)]
    with pytest.raises(ValueError):
        apply_mapping(spark.createDataFrame([("x",)], "timestampssincelastrevision string"), HEARTBEAT_MAPPING)


def test_mapping_nested_and_renamed(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("x"), F.lit(None).cast("int").alias("y")).alias("s"), F.lit("7").alias("n"), F.lit(0).alias("drop")
    )
    got = apply_mapping(df, [("s", "struct", "text", "string"), ("n", "string", "m", "int")]).first().asDict()
    assert got == {"text": '{"x":1,"y":null}', "m": 7}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "root"
    put(root / "in" / "2024" / "1" / "2" / "3" / "ds 1" / "r+1", "ü a%20.json", LINES[0])
    put(root / "in" / "2024" / "1" / "2" / "3" / "ds 1" / "r+1", "manifest.json", "{}")
    put(root / "in" / "2024" / "1" / "2" / "4" / "ds2" / "r2", "b.json", LINES[0], LINES[4])
    put(root / "in" / "2024" / "1" / "2" / "4" / "ds2" / "r2", "unlisted.json", LINES[0])
    return str(root)


def test_listing(spark, tree, rows, plan):
    df = list_assets(spark, tree)
    assert rows(df, "dataset_id", "revision_id", "name") == [
        ("ds 1", "r+1", "manifest.json"),
        ("ds 1", "r+1", "ü a%20.json"),
        ("ds2", "r2", "b.json"),
        ("ds2", "r2", "unlisted.json"),
    ]
    assert rows(list_files(spark, tree, "b*"), "key") == [("in/2024/1/2/4/ds2/r2/b.json",)]
    assert "content" not in plan(df)


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("narrow", [True, False])
def test_scan_reads_just_the_listed_files(spark, tree, rows, plan, limit, narrow):
    keys = ["in/2024/1/2/3/ds 1/r+1/ü a%20.json", "in/2024/1/2/4/ds2/r2/b.json", "in/2024/1/2/4/ds2/r2/gone.json"]
    wanted = spark.createDataFrame([(k,) for k in keys], "key string")
    folders = scan_folders(wanted, tree) if narrow else None
    assets = locate_assets(wanted, tree, folders)
    assert rows(assets.where("file_path IS NULL"), "key") == [(keys[2],)]
    df = scan_assets(assets, tree, broadcast_bytes=limit, folders=folders)
    assert rows(df.groupBy("key").count()) == [(keys[0], 1), (keys[1], 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(scan_assets(assets, tree, broadcast_bytes=limit, folders=folders))
        assert ("BroadcastHashJoin" in text) == (limit > 0)
        if limit:
            assert "Exchange hashpartitioning(file_path" not in text.split("BroadcastExchange")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [0, 1, 2, 1000])
def test_listing_of_requested_revisions(spark, tree, rows, limit):
    layout = "in/*/*/*/*/{dataset_id}/{revision_id}"
    asked = spark.createDataFrame(
        [("ds 1", "r+1"), ("ds 1", "r+1"), ("ds2", "none")], "dataset_id string, revision_id string"
    )
    got = list_requested(asked, tree, layout, limit)
    assert rows(got, "revision_id", "name") == [("r+1", "manifest.json"), ("r+1", "ü a%20.json")]
    assert list_requested(asked.where("revision_id = 'none'"), tree, layout, limit).isEmpty()


def test_scan_folders_are_bounded(spark, tree):
    assets = spark.createDataFrame([("x/a/1.json",), ("x/b/1.json",), ("x/a/2.json",)], "key string")
    assert sorted(scan_folders(assets, tree)) == [f"{tree}/x/a", f"{tree}/x/b"]
    assert scan_folders(assets, tree, max_folders=1) == [f"{tree}/x"]
    assert scan_folders(assets, tree, max_folders=0) is None
    odd = spark.createDataFrame([("x/a*/1.json",)], "key string")
    assert scan_folders(odd, tree) == [f"{tree}/x"]
    assert scan_folders(assets.limit(0), tree) is None


def test_broadcast_only_below_the_limit(spark, plan):
    small, big = spark.range(10).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(broadcast_if_small(small), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(small, 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_quotes_and_append(spark, tmp_path, rows):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([('["a,b","say \\"hi\\""]',), ("plain",), (None,), ("",)], "t string")
    write_csv(df, path, single_file=True)
    write_csv(df, path, single_file=True)
    files = [f for f in (tmp_path / "csv").iterdir() if f.name.startswith("part")]
    assert len(files) == 2
    text = files[0].read_text().splitlines()
    assert text[0] == "t"
    assert '"[""a,b"",""say \\""hi\\""""]"' in text
    assert text[1:].count('""') == 2  # a NULL alone in its row keeps its row
    back = spark.read.schema("t string").options(**CSV_OPTIONS).csv(path)
    assert sorted(r["t"] or "" for r in back.collect()) == sorted(['["a,b","say \\"hi\\""]', "plain", "", ""] * 2)


def test_named_csv(spark, tmp_path, rows):
    df = spark.range(100).select(
        "id", F.when(F.col("id") < 50, "ü a=1").otherwise("b").alias("asset")
    ).repartition(4)
    names = spark.createDataFrame([("ü a=1", "out/ü a=1.csv"), ("b", "out/b.csv"), ("none", "out/none.csv")], "asset string, target string")
    root = tmp_path / "root"
    for attempt in ("one", "two"):
        write_named_csv(df.where("asset = 'b'").coalesce(1).union(df.where("asset <> 'b'")), str(tmp_path / attempt), str(root), names, ["asset"])
        assert sorted(p.name for p in (root / "out").iterdir() if not p.name.endswith(".crc")) == ["b.csv", "none.csv", "ü a=1.csv"]
        assert (root / "out" / "b.csv").is_file() and (root / "out" / "ü a=1.csv").is_dir()
        assert (root / "out" / "none.csv").read_text() == "id\n"
        for name, low in (("ü a=1", 0), ("b", 50)):
            back = spark.read.schema("id long").options(**CSV_OPTIONS).csv(f"{root}/out/{name}.csv")
            assert sorted(r["id"] for r in back.collect()) == list(range(low, low + 50))


def test_named_csv_refuses_one_name_for_two(spark, tmp_path):
    names = spark.createDataFrame([("a", "x.csv"), ("b", "x.csv")], "asset string, target string")
    with pytest.raises(ValueError):
        write_named_csv(spark.range(1).withColumn("asset", F.lit("a")), str(tmp_path / "s"), str(tmp_path), names, ["asset"])


def test_read_events(spark, tmp_path):
    put(tmp_path, "e.txt", "one", "two")
    df = read_events(spark, str(tmp_path))
    assert sorted(r["value"] for r in df.collect()) == ["one", "two"]
    assert df.where("arrived_at IS NULL").isEmpty()
