"""The battery's own spans: planted keys among ordinary runs, statistics in plain Python, many spans."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secret_scan

SMALL, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "base62": SMALL + SMALL.upper() + DIGITS,
    "base64": SMALL + SMALL.upper() + DIGITS + "+/",
    "base32": SMALL.upper() + "234567",
}
PARTS = (
    "the and tion ing ment configuration parameter service account lich keit schen verein heit einung "
    "aux ement elle leur ouvrage cion mente dad losas pro test value list index user name path"
).split()


def ordinary(rng):
    """A joined-word run of at least 20 characters: plain, snake, kebab, path, camel, numbered."""
    style, words = rng.randrange(6), [rng.choice(PARTS) for _ in range(12)]
    if style == 4:
        words = [w.capitalize() for w in words]
    out = words[0]
    for w in words[1:]:
        if len(out) >= 20 and rng.random() < 0.6:
            break
        out += ("", "_", "-", "/", "", "_")[style] + w
    return out + (str(rng.randrange(100)) if style == 5 else "")


def planted(rng, lengths, each, n_ordinary):
    keys = [(name, n, "".join(rng.choice(a) for _ in range(n))) for name, a in ALPHABETS.items() for n in lengths for _ in range(each)]
    rows = [f"see {k} there" for _, _, k in keys] + [f"see {ordinary(rng)} there" for _ in range(n_ordinary)]
    return keys, list(enumerate(rows))


def test_planted_keys_at_one_percent_are_found(spark):
    keys, rows = planted(random.Random(4), (20, 24, 31, 32, 40, 64), 6, 10800)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"] for r in secret_scan.find_secrets(docs).filter(F.size("spans") > 0).select("doc_id").collect()}
    false = [rows[i][1] for i in found if i >= len(keys)]
    assert len(false) <= 0.05 * len(found), false[:5]
    for name in ALPHABETS:
        from_32 = [i for i, (a, n, _) in enumerate(keys) if a == name and n >= 32]
        assert sum(i in found for i in from_32) >= 0.9 * len(from_32), name
    short = [i for i, (a, n, _) in enumerate(keys) if n < 32]
    assert sum(i in found for i in short) >= 0.7 * len(short)


def plain_evidence(hit, encoding):
    alphabet = secret_scan.ENCODINGS[encoding][1]
    hit = [c for c in hit if c in alphabet]
    total, before, bits = sum(secret_scan.LETTERS.values()), "sign", 0.0
    for c in hit:
        kind = "sign" if c in "+/_=-" else "digit" if c.isdigit() else "lower" if c.islower() else "upper"
        share = {"sign": 1 / 5, "digit": 1 / 10}.get(kind) or secret_scan.LETTERS[c.lower()] / total
        bits -= math.log2(secret_scan.KIND_MOVES[before][kind] * share)
        before = kind
    return bits - len(hit) * math.log2(len(alphabet)) - math.log2(len(secret_scan.ENCODINGS))


def plain_p_random(hit, encoding):
    alphabet = secret_scan.ENCODINGS[encoding][1]
    v = [alphabet.index(c) + 1 for c in hit if c in alphabet]
    n, k = len(v), len(alphabet)
    below = lambda z: (1 + math.erf(z / math.sqrt(2))) / 2
    pairs, same = n * (n - 1) / 2, sum(c * (c - 1) / 2 for c in Counter(v).values())
    z_chi = (same - pairs / k) / math.sqrt(pairs / k * (1 - 1 / k))
    high = [x > k / 2 for x in v]
    mixed = 2 * sum(high) * (n - sum(high))
    var = mixed * (mixed - n) / (n * n * (n - 1))
    z_runs = (sum(a != b for a, b in zip(high, high[1:])) - mixed / n) / math.sqrt(var) if var > 0 else 9.0
    mean = sum(v) / n
    spread = sum((x - mean) ** 2 for x in v)
    lagged = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:]))
    z_serial = (lagged / spread + 1 / n) * math.sqrt(n) if spread > 0 else 9.0
    return 3 * min(below(-z_chi), 2 * below(-abs(z_runs)), 2 * below(-abs(z_serial)))


def test_statistics_equal_plain_python(spark):
    rng = random.Random(5)
    keys, rows = planted(rng, (20, 33, 64), 3, 40)
    rows += [(900, "x " + "ab" * 10 + "/" + "Q" * 9), (901, "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"), (902, "a" * 30 + " " + "12" * 20)]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("text", F.explode("runs").alias("r")).collect()
    assert len(got) >= len(keys) + 40
    for r in got:
        run = r["r"]
        hit = r["text"][run["start"] : run["end"]]
        assert run["evidence"] == pytest.approx(plain_evidence(hit, run["encoding"]))
        assert run["p_random"] == pytest.approx(plain_p_random(hit, run["encoding"]), abs=1e-6)
        assert run["bin"] == min(128, max(0, math.floor(run["evidence"])))


def test_family_leaves_out_what_says_nothing(spark):
    rows = [(0, "-" * 40), (1, "abab" * 10), (2, "0123456789" * 3), (3, "0a1b2c3d4e5f" * 3), (4, ""), (5, None)]
    assert all(r["runs"] == [] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_evidence_is_a_p_value_under_the_text_model():
    """Runs drawn from the text model exceed b bits with probability 2^-b at most."""
    rng, n = random.Random(6), 4000
    letters, weights = zip(*secret_scan.LETTERS.items())
    counts = Counter()
    for _ in range(n):
        before, out = "sign", ""
        for _ in range(24):
            moves = secret_scan.KIND_MOVES[before]
            before = rng.choices(list(moves), list(moves.values()))[0]
            letter = rng.choices(letters, weights)[0]
            out += {"lower": letter, "upper": letter.upper(), "digit": rng.choice(DIGITS), "sign": rng.choice("+/_=-")}[before]
        enc = next((e for e, (p, _) in secret_scan.ENCODINGS.items() if p and re.match(p, out)), "base64url")
        bits = plain_evidence(out, enc)
        for b in (1, 3, 6):
            counts[b] += bits >= b
    assert all(counts[b] / n <= 2.0**-b for b in (1, 3, 6))


def test_many_spans_in_one_text(spark):
    rng = random.Random(7)
    parts = [("é" * (i % 3)) + "".join(rng.choice("0123456789abcdef") for _ in range(20 + i % 5)) for i in range(8000)]
    text = " , ".join(parts)
    df = spark.createDataFrame([(1, text), (2, text[:5000] + ' token="' + "b" * 20 + '"')], "doc_id long, text string")
    start = time.monotonic()
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(df).collect()}
    assert time.monotonic() - start < 25
    assert masked[1] == re.sub("[0-9a-f]{16,}", "[SECRET]", text)
    assert masked[2].endswith(' [SECRET]"')
    spans = secret_scan.find_secrets(df).filter("doc_id = 1").select("base").first()["base"]
    assert [(s["start"], s["end"]) for s in spans] == [m.span() for m in re.finditer("[0-9a-f]{16,}", text)]
