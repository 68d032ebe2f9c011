"""Batch bookmarks and mappings over records that disagree."""

import json

import pytest
from pyspark.sql import types as T

from tidemark.operators.mapping import apply_variant_mapping, bad_values
from tidemark.sources import bookmarks
from tidemark.sources.json_lines import read_variant_lines

SCHEMA = T.StructType([T.StructField("n", T.LongType())])


@pytest.mark.parametrize("most", [0, 1000])
def test_a_file_is_read_once_in_each_form(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(bookmarks, "MAX_FOLDERS", most)
    root, ledger = tmp_path / "root", str(tmp_path / "ledger")

    def put(name, *numbers):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("".join(json.dumps({"n": n}) + "\n" for n in numbers))

    def run(number):
        return sorted(r["n"] for r in bookmarks.bookmarked_scan(spark, str(root), ledger, number, SCHEMA).collect())

    put("x/a.json", 1, 2)
    put("y/b.json", 3)
    assert run(0) == [1, 2, 3] == run(0)
    put("z/c.json", 4)
    assert run(0) == [1, 2, 3]  # a repeated run keeps its list
    assert run(1) == [1, 2, 3, 4]  # the first never committed
    bookmarks.commit(spark, ledger, 1)
    assert run(2) == []
    put("x/a.json", 5, 6, 7)
    assert run(3) == [5, 6, 7]
    bookmarks.commit(spark, ledger, 3)
    assert run(4) == []


@pytest.mark.parametrize("most", [0, 1000])
def test_names_with_signs_are_read(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(bookmarks, "MAX_FOLDERS", most)
    folder = tmp_path / "root" / "in" / "k=ü a"
    folder.mkdir(parents=True)
    for n, name in enumerate(["a b.json", "c%20d.json", "e+f.json", "plain.json"]):
        (folder / name).write_text(json.dumps({"n": n}) + "\n")
    got = bookmarks.bookmarked_scan(spark, str(tmp_path / "root"), str(tmp_path / "ledger"), 0, SCHEMA)
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 2, 3]


def test_variant_mapping(spark, tmp_path):
    lines = ['{"v":1}', '{"v":"2"}', '{"v":[1,{"a":"b"}]}', '{"v":null}', "{}", '{"v":"x"}', '{"v":2.5}', '{"v":true}']
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    rows = read_variant_lines(spark, str(tmp_path / "in.json"))
    numbers = apply_variant_mapping(rows, [("v", "bigint", "n", "int"), ("v", "string", "n", "int")]).collect()
    assert [r["n"] for r in numbers] == [1, 2, None, None, None, None, None, None]
    assert [[b["held"] for b in r["bad"]] for r in numbers] == [
        [], [], ['[1,{"a":"b"}]'], [], [], ['"x"'], ["2.5"], ["true"],
    ]
    texts = apply_variant_mapping(rows, [("v", t, "t", "string") for t in ("array", "bigint", "double", "boolean", "string")])
    assert [r["t"] for r in texts.collect()] == ["1", "2", '[1,{"a":"b"}]', None, None, "x", "2.5", "true"]
    with pytest.raises(ValueError):
        apply_variant_mapping(rows, [("v", "array", "n", "int")])


def test_bad_values(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, None, "7"), (3, "y", "z")], "id int, a string, b string")
    got = bad_values(df, [("a", "string", "p", "int"), ("b", "string", "q", "int")], ["id"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "q", "x"), (3, "p", "y"), (3, "q", "z")]
