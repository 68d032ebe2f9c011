from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import status, text


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_json_text_keeps_nulls(spark):
    value = F.struct(F.lit("b").alias("bucket"), F.lit(None).cast("string").alias("version"))
    assert one(spark, text.json_text(value)) == '{"bucket":"b","version":null}'


def test_array_text_styles(spark):
    value = F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("b,c"))
    assert one(spark, text.array_text(value)) == '["a",null,"b,c"]'
    assert one(spark, text.array_text(value, "cast")) == "[a, NULL, b,c]" or one(
        spark, text.array_text(value, "cast")
    ) == "[a, null, b,c]"
    with pytest.raises(ValueError):
        text.array_text(value, "other")


def test_first_or_null(spark):
    assert one(spark, text.first_or_null(F.array(F.lit("x"), F.lit("y")))) == "x"
    assert one(spark, text.first_or_null(F.array().cast("array<string>"))) is None


@pytest.mark.parametrize(
    ("name", "stem", "file_stem"),
    [
        ("a.json", "a", "a"),
        ("a.v1.json", "a", "a.v1"),
        ("plain", "plain", "plain"),
        (".hidden", "", ".hidden"),
        ("ü b.json", "ü b", "ü b"),
    ],
)
def test_stems(spark, name, stem, file_stem):
    assert one(spark, text.stem(F.lit(name))) == stem
    assert one(spark, text.file_stem(F.lit(name))) == file_stem


def test_paths(spark):
    assert one(spark, text.base_name(F.lit("a/b/c.json"))) == "c.json"
    assert one(spark, text.parent(F.lit("a/b/c.json"))) == "a/b"
    assert one(spark, text.path_only(F.lit("file:/a/b"))) == "/a/b"
    assert one(spark, text.path_only(F.lit("file:///a/b"))) == "/a/b"
    assert one(spark, text.path_only(F.lit("s3a://bucket/a:b"))) == "/a:b"
    assert one(spark, text.path_only(F.lit("/a/b"))) == "/a/b"
    assert one(spark, text.decoded_path(F.lit("x%20y+z%2525"))) == "x y+z%25"


def test_time_formats(spark):
    at = F.lit("2021-06-21 16:59:38.249330").cast("timestamp")
    assert one(spark, text.time_text(at)) == "2021-06-21 16:59:38.249330"
    assert one(spark, text.time_text(F.lit("2021-06-21 16:59:38").cast("timestamp"))).endswith(":38.000000")
    assert one(spark, text.epoch_millis(F.timestamp_millis(F.lit(1624322915263)))) == 1624322915263
    assert one(spark, text.hour_prefix("p", at)) == "p/2021/6/21/16/"
    assert one(spark, text.revision_prefix("p", at, F.lit("d"), F.lit("r"))) == "p/2021/6/21/16/d/r/"


@pytest.mark.parametrize(
    ("state", "action"),
    [("SUCCEEDED", "SUCCEEDED"), ("FAILED", "FAILED"), ("RUNNING", "POLL"), (None, "POLL")],
)
def test_action_status(spark, state, action):
    assert one(spark, status.action_status(F.lit(state).cast("string"))) == action


def test_gate_and_route(spark):
    assert one(spark, status.in_gate(F.lit(datetime(2024, 1, 1, 5, 9, 59))))
    assert not one(spark, status.in_gate(F.lit(datetime(2024, 1, 1, 5, 10, 0))))
    for check, action, step in [
        (False, "FAILED", "succeed"),
        (True, "SUCCEEDED", "wait"),
        (True, "FAILED", "fail"),
        (True, "POLL", "poll"),
    ]:
        assert one(spark, status.route(F.lit(check), F.lit(action))) == step
    assert one(spark, status.gate_step(F.lit(True))) == "poll"
