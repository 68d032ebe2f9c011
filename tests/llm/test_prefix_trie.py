"""The trie against plain Python dictionaries."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as op

SCHEMA = "conv_id long, turn long, role string, text string, path string, n int, depth int"


def unit_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32] + f"{len(text):08x}"


def rebuilt(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, unit_of(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    saved = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in members.items()}
    for path, found in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        ends = ",".join(map(str, sorted(c for c in found if len(paths[c]) == len(path))))
        out.add((
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(children), len(leaves),
            sum(saved[p] for p in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def random_rows(seed, convs=260):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if c == 200:
            continue  # a base that isn't there
        for t in range(rng.choice([1, 2, 3, 5, 8, 8])):
            text = rng.choice(["hello", "yes", "né 🎉", None, "", "x" * 50])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), text))
    for c in range(300, 400):  # a third of all paths the same
        rows += [(c, t, "user", "hello") for t in range(7)]
    rows += [(None, 0, "user", "hello"), (-7, 0, "user", "hello")]
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_trie_matches_brute_force(spark, shard_bytes):
    rows = random_rows(4)
    got = [tuple(r) for r in op.conversation_trie(frame(spark, rows).repartition(4), shard_bytes).collect()]
    want = brute({c: t for c, t in rebuilt(rows).items()})
    assert len(got) == len(want) and set(got) == want


def test_deep_shared_paths_and_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 50 else f"{c} {t}") for c in range(1, 40) for t in range(50 + c % 4)]
    rows += [(99, t, "user", f"long {t}") for t in range(2000)]
    got = {tuple(r) for r in op.conversation_trie(frame(spark, rows), 500).collect()}
    paths = rebuilt(rows)
    long_path = paths.pop(99)
    want = brute(paths)
    # the long conversation shares only the root
    root = next(w for w in want if w[1] == 0)
    want = want - {root} | {(1, 0, None, 40, root[4] + 1, root[5] + 1, root[6], root[7])}
    rest = got - want
    assert want <= got and len(rest) == len(long_path) and all(r[0] == 99 and r[6] == 0 for r in rest)


def test_splitters_and_skeleton():
    a, b, c = (bytes([i]) * op.UNIT for i in (1, 2, 3))
    splitters = op.choose_splitters([a + a, a + b, a + b + c, b], 4)
    assert splitters == sorted(splitters) and all(len(s) % op.UNIT == 0 for s in splitters)
    skeleton = op.Skeleton([a + b + c, b])
    assert [len(x) for x in skeleton.ancestors] == [0, 1, 2]
    assert [skeleton.shard(p) for p in (b"", a, a + b + c, b, c)] == [0, 0, 1, 2, 2]
    rng = random.Random(1)
    for _ in range(500):
        x, y = (b"".join(rng.choice([a, b]) for _ in range(rng.randrange(12))) for _ in range(2))
        n = op.shared_turns(x, y) * op.UNIT
        assert x[:n] == y[:n] and (x[n : n + op.UNIT] != y[n : n + op.UNIT] or not (x[n:] and y[n:]))


def test_empty_and_turnless(spark):
    assert op.conversation_trie(frame(spark, [(1, 0, "user", "x")]).where(F.lit(False))).count() == 0
    # a conversation whose own turns all lie before the cut, without a base, has no turn left
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    got = [tuple(r) for r in op.conversation_trie(frame(spark, [(c, 0, "user", "x")])).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
