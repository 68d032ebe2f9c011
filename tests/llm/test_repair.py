"""Conversation repair against a search over all edit strings, and against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

from pyspark.sql import functions as F

from tidemark.llm import repair as op

SCHEMA = "conv_id long, turn long, role string, text string, kept string, copies_of int, _c int"


def damage(rows):
    """Rows after damage by conversation; every conversation is there."""
    out = {}
    for conv_id, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv_id, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(shown).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        found = out.setdefault(conv_id, [])
        found += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, t in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0d]", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, lines) by recursion over whole edit strings; the least wins."""
    kinds = faults(rows)

    @cache
    def go(i, said, inserts):
        options = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            options.append((0, "", ()))
        # what was said only matters by its last sign
        trim = lambda s: s if len(s) < 3 else {"u": "u", "a": "ua"}[s[-1]]

        def follow(cost, edit, role, text, j, n):
            new = said + role[:1]
            rest = go(j, trim(new), n) if re.fullmatch("(s?(ua)*u?)?", new) else None
            if rest:
                options.append((cost + rest[0], edit + rest[1], ((f"{role}:{text}",) if role else ()) + rest[2]))
        if inserts < 4:
            for role in ("user", "assistant"):
                follow(2, "I", role, "", i, inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            follow(3, "D", "", "", i + 1, 0)
            if kinds[i] not in ("blank", "duplicate"):
                extra = kinds[i] == "truncated"
                if role[:1] in ("s", "u", "a"):
                    follow(extra, "K", role, text, i + 1, 0)
                for new in ("user", "assistant"):
                    follow(2 + extra, "R", new, text, i + 1, 0)
        return min(options, default=None)

    return go(0, "", 0)


def expected(rows):
    out = {}
    for conv_id, turns in damage(rows).items():
        kinds = faults(turns)
        numbers = {t for t, _, _ in turns if t is not None}
        pairs = zip(turns, turns[1:], strict=False)
        cost, audit, lines = best(turns)
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines,
        )
    return out


def random_rows(seed, convs=120, longest=9):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why? ", "", " \n", "Go on!", None, "x\x0b", "end?"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "umpire"]
    rows = []
    for c in range(convs):
        good = rng.random() < 0.5
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, 2 * t, None, 1])
            role = ("user", "assistant")[t % 2] if good else rng.choice(roles)
            rows.append((c if c else None, turn, role, rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 7, 1) for r in rows], SCHEMA)


def check(spark, rows, spill):
    table = op.damaged(frame(spark, rows).repartition(5))
    got = {r.conv_id: tuple(r)[1:] for r in op.repair(table, spill).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for c, w in want.items():
        assert got[c] == w[:8], (c, damage(rows)[c])
    lines = {}
    for r in op.repaired_turns(table, spill).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: list(w[8]) for c, w in want.items() if w[8]}


def test_random_conversations(spark):
    rows = random_rows(1)
    assert {1, 2, 3} <= {len(x) for x in damage(rows).values()}
    check(spark, rows, op.SPILL)


def test_spilled_pointers_give_the_same(spark):
    check(spark, random_rows(2, convs=60, longest=20), 3)


def test_state_crosses_batches(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.common.BATCH_ROWS", 2)
    check(spark, random_rows(3, convs=40), op.SPILL)


def test_all_short_role_strings():
    steps = op.Steps()
    texts = {"u": "user", "a": "assistant", "s": "system", "x": "xeno"}
    for n in range(5):
        for roles in itertools.product("uasx", repeat=n):
            for broken in range(2**n):
                rows = [(i, texts[r], f"{i} " + ("." if broken >> i & 1 else "-")) for i, r in enumerate(roles)]
                talk = op.Conversation(0, steps)
                for turn, role, text in rows:
                    talk.add(turn, role, text, True)
                end = talk.end()
                cost, audit, _ = best(rows)
                assert (end["cost"], end["audit"]) == (cost, audit), rows


def test_dropped_rows_and_empty_tables(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    for row in op.repair(op.damaged(frame(spark, gone))).collect():
        assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = frame(spark, gone).where(F.lit(False))
    assert op.repair(op.damaged(empty)).count() == 0 and op.repaired_turns(empty).count() == 0


def test_long_conversation_and_long_text(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} " + "x" * (100_000 if t == 5 else 10) + ".") for t in range(3000)]
    got = op.repair(frame(spark, rows), 1000).collect()[0]
    assert got.audit == "K" * 3000 and got.cost == 0 and got.gaps == 0
    lines = "\n".join(f"{r}:{x}" for _, _, r, x in rows)
    assert got.repaired_sha256 == hashlib.sha256(lines.encode()).hexdigest()
