import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import dedup_events, match_events, open_envelopes, parse_events, unreadable_events


def body(dataset="d1", revisions=("r1",), source="feed", kind="published", resources=None):
    return json.dumps(
        {
            "source": source,
            "detail-type": kind,
            "resources": [dataset] if resources is None else resources,
            "detail": {"RevisionIds": list(revisions)},
        }
    )


def queue(*bodies):
    return json.dumps({"Records": [{"body": b} for b in bodies]})


MANUAL = json.dumps({"InitialInit": {"data_set_id": "m", "RevisionIds": "r9"}})


def raw(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, value string")


def test_all_records_and_revisions(spark, rows):
    df = raw(spark, queue(body(), body("d2", ["r2", "r3"])), MANUAL)
    assert rows(parse_events(df)) == [(0, "d1", "r1"), (0, "d2", "r2"), (0, "d2", "r3"), (1, "m", "r9")]


def test_last_record_only(spark, rows):
    df = raw(spark, queue(body(), body("d2", ["r2", "r3"])), MANUAL, queue())
    assert rows(parse_events(df, last_only=True)) == [(0, "d2", "r2"), (0, "d2", "r3"), (1, "m", "r9")]


def test_manual_start_wins(spark, rows):
    both = json.dumps({**json.loads(MANUAL), **json.loads(queue(body()))})
    assert rows(parse_events(raw(spark, both))) == [(0, "m", "r9")]


def test_unreadable(spark, rows):
    df = raw(
        spark,
        queue(body(), "{broken", body(resources=[])),
        "not json",
        json.dumps({"InitialInit": {"data_set_id": "m"}}),
        queue(body(revisions=[])),
        MANUAL,
    )
    assert rows(parse_events(df)) == [(0, "d1", "r1"), (4, "m", "r9")]
    assert rows(unreadable_events(df), "id", "record_pos") == [(0, 1), (0, 2), (1, None), (2, None), (3, 0)]


def test_event_rule(spark, rows):
    df = open_envelopes(
        raw(
            spark,
            queue(
                body("d1"),
                body("d2"),
                body("d1", source="else"),
                body("d1", kind="else"),
                body(resources=[]),
                body(resources=["x", None, "d1"]),
                body(resources=["x", None]),
            ),
        )
    )
    hit = match_events(df, ["feed"], ["published"], ["d1", "d9"])
    assert rows(hit, "record_pos") == [(0,), (5,)]
    everything = match_events(df, ["feed"], ["published"])
    assert rows(everything, "record_pos") == [(0,), (1,), (4,), (5,), (6,)]


def test_rule_is_never_null(spark):
    from tidemark.operators.events import event_rule

    df = open_envelopes(raw(spark, MANUAL, queue(body(resources=[None]))))
    rule = event_rule(F.col("event"), ["feed"], ["published"], ["d1"])
    assert [r[0] for r in df.select(rule).collect()] == [False, False]


def test_dedup_keeps_earliest_and_survives_a_hot_body(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("body"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
        F.col("id"),
    )
    kept = dedup_events(df, ["g"], "body", ["id"])
    assert kept.count() == 2000 + 2
    assert rows(kept.where("body = 'hot'"), "g", "id") == [("a", 0), ("b", 3)]


@pytest.mark.parametrize("text", ["", "ü", "x" * 5000])
def test_dedup_compares_whole_bodies(spark, text):
    df = spark.createDataFrame([("g", text + "1", 1), ("g", text + "2", 2), ("g", text + "1", 3)], "g string, b string, n int")
    assert sorted(r["n"] for r in dedup_events(df, ["g"], "b", ["n"]).collect()) == [1, 2]


def test_each_body_is_parsed_once(spark, plan):
    from tidemark.operators.events import event_rule, requested_revisions

    opened = open_envelopes(raw(spark, queue(body())))
    wanted = opened.where(F.col("manual").isNotNull() | event_rule(F.col("event"), ["feed"], ["published"], ["d1"]))
    assert plan(requested_revisions(wanted)).count("from_json(") == 2
