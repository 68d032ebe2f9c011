"""Operators on random rows with a hot key, against plain Python."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import event_rule, open_envelopes, parse_events
from tidemark.operators.messages import outbound_messages, split_oversize
from tidemark.operators.revisions import asset_descriptor, build_revisions
from tidemark.operators.state import put_revisions, update_revisions
from tidemark.operators.status import job_status, pending_jobs, unsettled_jobs
from tidemark.schemas import LISTING


@pytest.fixture(scope="module")
def listing():
    """A third of all files belong to one revision; names come in random order."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        revision = "hot" if i % 3 == 0 else f"r{rng.randrange(150)}"
        name = rng.choice(["manifest", "data", "ü"]) + f"-{i}." + rng.choice(["json", "v1.json"])
        rows.append((f"d{rng.randrange(2)}", revision, rng.randrange(10_000) * 3000 + i, name))
    return rows


def grouped(listing):
    groups = defaultdict(list)
    for dataset, revision, pos, name in sorted(listing, key=lambda r: (r[2], r[3])):
        groups[dataset, revision].append((pos, name))
    return groups


def test_catalog(spark, listing):
    at = F.lit("2024-05-06 07:08:09").cast("timestamp")
    got = build_revisions(spark.createDataFrame(listing, LISTING), "b", "in", at, max_rows=40)
    seen = {(r["dataset_id"], r["revision_id"]): r for r in got.collect()}
    groups = grouped(listing)
    assert seen.keys() == groups.keys()
    for (dataset, revision), files in groups.items():
        row = seen[dataset, revision]
        manifests = [n for _, n in files if n.startswith("manifest")]
        data = [n for _, n in files if not n.startswith("manifest")]
        assert row["metadata"] == (manifests[-1] if manifests else None)
        assert row["n_data_files"] == len(data)
        keys = [f"in/2024/5/6/7/{dataset}/{revision}/{n}" for n in data]
        if len(data) > 40:
            assert row["data_files"] is None
        elif not data:
            assert row["data_files"] == {}
        else:
            assert [a["key"] for a in row["data_files"]["heartbeat"]] == keys


@pytest.mark.parametrize("limit", [300, 1000, 2048])
def test_messages(spark, listing, limit):
    assets = spark.createDataFrame(listing, LISTING).select(
        "dataset_id",
        "revision_id",
        "pos",
        "name",
        asset_descriptor("b", F.col("name")).alias("asset"),
        F.concat(F.lit("csv/"), "name").alias("csv_key"),
    )

    def text(key, names):
        files = [{"bucket": "b", "key": n, "version": None} for n in names]
        message = {"dataset_id": key[0], "revision_id": key[1], "dataFilesMap": {"heartbeat": files}}
        return json.dumps(message, separators=(",", ":"), ensure_ascii=False)

    final, progress = {}, {}
    for key, files in grouped(listing).items():
        names = [n for _, n in files]
        final[(*key, None)] = text(key, [f"csv/{n}" for n in names])
        for i, (pos, _) in enumerate(files):
            progress[(*key, pos)] = text(key, [f"csv/{n}" for n in names[: i + 1]] + names[i + 1 :])
    for mode, want in (("revision", final), ("progress", progress)):
        sent, rejected = split_oversize(outbound_messages(assets, mode, limit), limit)
        got = {(r["dataset_id"], r["revision_id"], r["pos"]): r["message"] for r in sent.collect()}
        assert got == {k: m for k, m in want.items() if len(m.encode()) <= limit}
        left = {(r["dataset_id"], r["revision_id"], r["pos"]) for r in rejected.collect()}
        assert left == {k for k, m in want.items() if len(m.encode()) > limit}


def test_put_and_update(spark):
    rng = random.Random(8)
    keys = [(f"d{rng.randrange(3)}", f"r{i}") for i in range(400)]
    old = {k: ("READY", f"m{i}") for i, k in enumerate(keys)}
    new = {k: (rng.choice(["READY", None]), None) for k in keys[::3]} | {("d9", f"n{i}"): ("READY", "x") for i in range(30)}
    schema = "dataset_id string, revision_id string, status string, metadata string"

    def frame(rows):
        return spark.createDataFrame([(*k, *v) for k, v in rows.items()], schema)

    def held(df):
        rows = [tuple(r) for r in df.collect()]
        assert len(rows) == len({r[:2] for r in rows})
        return {r[:2]: r[2:] for r in rows}

    assert held(put_revisions(frame(old), frame(new))) == old | new
    want = {k: (new[k][0] if k in new else v[0], v[1]) for k, v in old.items()}
    assert held(update_revisions(frame(old), frame(new), ["status"])) == want


def test_jobs(spark, rows):
    rng = random.Random(9)
    requested = ["hot" if i % 3 == 0 else f"j{rng.randrange(300)}" for i in range(900)]
    done = ["hot" if i % 3 == 0 else f"j{rng.randrange(400)}" for i in range(900)]
    left, right = (spark.createDataFrame([(j,) for j in ids], "job_id string") for ids in (requested, done))
    assert rows(pending_jobs(left, right)) == sorted((j,) for j in requested if j not in set(done))
    want = [(j, "requested") for j in set(requested) - set(done)] + [(j, "done") for j in set(done) - set(requested)]
    assert rows(unsettled_jobs(left, right)) == sorted(want)

    runs = [(j, rng.randrange(10**6) * 1000 + i, rng.choice(["SUCCEEDED", "FAILED", "RUNNING"])) for i, j in enumerate(requested)]
    newest = {}
    for job, at, state in sorted(runs, key=lambda r: r[1]):
        newest[job] = state
    got = job_status(spark.createDataFrame(runs, "job_name string, started_at long, state string"))
    assert dict(rows(got, "job_name", "run_state")) == newest


def test_events(spark):
    rng = random.Random(10)
    envelopes, want, matched = [], [], 0
    for i in range(500):
        if rng.random() < 0.2:
            envelopes.append({"InitialInit": {"data_set_id": f"m{i}", "RevisionIds": "r"}})
            want.append((f"m{i}", "r"))
            continue
        records = []
        for _ in range(rng.randrange(4)):
            resources = [f"d{rng.randrange(5)}" for _ in range(rng.randrange(3))]
            ids = [f"r{rng.randrange(9)}" for _ in range(rng.randrange(3))]
            source = rng.choice(["a", "b", "c"])
            body = {"source": source, "detail-type": "t", "resources": resources, "detail": {"RevisionIds": ids}}
            records.append({"body": json.dumps(body)})
            want += [(resources[0], r) for r in ids if resources]
            matched += source in "ab" and bool({"d1", "d2"} & set(resources))
        envelopes.append({"Records": records})
    raw = spark.createDataFrame([(json.dumps(e),) for e in envelopes], "value string")
    assert sorted(tuple(r) for r in parse_events(raw).collect()) == sorted(want)
    rule = event_rule(F.col("event"), ["a", "b"], ["t"], ["d1", "d2"])
    assert open_envelopes(raw).where(rule).count() == matched
