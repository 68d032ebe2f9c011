"""Lists too long for a row: numbered with one shuffle, their revisions made once."""

from pyspark.sql import functions as F

from tidemark.operators.revisions import build_revisions, data_assets, every_asset
from tidemark.operators.sizing import numbered


def test_numbering_sorts_rows_once(spark, tmp_path, plan):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("k"), (F.col("id") * 37 % 50).alias("o"), "id"
    )
    placed = numbered(rows, ["k"], ["o"], str(tmp_path / "ranges"))
    text = plan(placed)
    # a window over the sums of the ranges, and none over the rows
    assert text.count("row_number") == 0
    for key, n in (("a", 2000), ("b", 1000)):
        mine = sorted((r["place"], r["o"]) for r in placed.where(F.col("k") == key).collect())
        assert [p for p, _ in mine] == list(range(n))
        assert [o for _, o in mine] == sorted(o for _, o in mine)


def test_long_lists_are_neither_packed_nor_listed_twice(spark, plan):
    files = spark.range(3020).select(
        F.lit("d").alias("dataset_id"),
        F.when(F.col("id") < 3000, "long").when(F.col("id") < 3010, "short").alias("revision_id"),
        "id",
    ).select("dataset_id", "revision_id", F.col("id").alias("pos"), F.concat(F.lit("f"), "id").alias("name"))
    at = F.lit("2024-01-02").cast("timestamp")
    revisions = build_revisions(files, "b", "in", at, max_rows=20)
    assert sorted(r["n_data_files"] for r in revisions.where("data_files IS NULL").collect()) == [10, 3000]
    found = every_asset(revisions, data_assets(files, "b", "in", at))
    got = sorted((r["revision_id"], r["pos"], r["asset"]["key"].split("/")[-1]) for r in found.collect())
    assert got == sorted([("long", i, f"f{i}") for i in range(3000)] + [("short", i, f"f{3000 + i}") for i in range(10)])
    # what the revisions are made of is not read again
    assert "WindowGroupLimit" not in plan(found)
