"""Token attribution and language-model scores against plain Python, value by value."""

import base64
import math
import random
import zlib
from collections import Counter

import pytest
import tiktoken

from tests.llm.conftest import PATTERN, RANKS, sentence
from tidemark.llm import bloom_lm, token_counts
from tidemark.llm.common import word_list

ODD = ["a", "é", "日本", "🎉", " ", "  ", "\n", "\n\n", "the ", "don't", "\x85", "👩‍👩‍👧", "12345", "\t", "ÿ", "x" * 30]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def spans(library, text):
    """Characters of every token: from the one its first byte belongs to, to the last one begun in it."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    first = [j == 0 or owner[j] != owner[j - 1] for j in range(len(owner))]
    out, at = [], 0
    for token in library.decode_tokens_bytes(library.encode_ordinary(text)):
        begun = [owner[j] for j in range(at, at + len(token)) if first[j]]
        start = owner[at]
        out.append((start, begun[-1] + 1 if begun else start + 1, begun))
        at += len(token)
    return out


def told(library, text, sections, rule):
    """Tokens of every section by the rule, one token and one character at a time."""
    tokens = spans(library, text)
    out = []
    for first, last in sections:
        if first >= last:
            out.append(0)
        elif rule == "start":
            out.append(sum(first <= a < last for a, _, _ in tokens))
        elif rule == "middle":
            out.append(sum(2 * first <= a + b < 2 * last for a, b, _ in tokens))
        else:
            # a character belongs to the token that holds its first byte; a token that holds
            # no first byte counts whole where the character of its bytes is
            shares = [(begun or [a]) for a, _, begun in tokens]
            out.append(sum(sum(first <= c < last for c in own) / len(own) for own in shares))
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_equals_one_token_at_a_time(spark, library, rule):
    rng = random.Random(21)
    rows, wanted = [], {}
    for i in range(150):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 40)))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(4))
        # neighbours, an overlap, an empty one and the whole text
        sections = [(cuts[0], cuts[1]), (cuts[1], cuts[2]), (cuts[0], cuts[3]), (cuts[2], cuts[2]), (0, len(text))]
        rows.append((i, text, [(str(k), a, b) for k, (a, b) in enumerate(sections)]))
        wanted[i] = told(library, text, sections, rule)
    df = spark.createDataFrame(rows, f"doc_id long, text string, spans {token_counts.SECTION}")
    got = token_counts.count_tokens(df, RANKS, PATTERN, sections="spans", rule=rule).collect()
    assert len(got) == len(rows)
    for row in got:
        assert [c["n"] for c in row["counts"]] == pytest.approx(wanted[row["doc_id"]], abs=1e-9), rows[row["doc_id"]]


def level_count(n):
    """What a count is read back as: the middle of its power of two."""
    level = n.bit_length()
    return 0.0 if n == 0 else 1.0 if level == 1 else 2.0 ** (level - 0.5)


def exact_scores(docs):
    tokens = {d: [*word_list(t or ""), "\0"] for d, t in docs}
    learnt = [ws for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10]
    single = Counter(w for ws in learnt for w in ws)
    pair = Counter(p for ws in learnt for p in zip(["\0", *ws], ws))
    total, norm = sum(single.values()), sum(single.values()) + 0.1 * (len(single) + 1)
    out = {}
    for d, ws in tokens.items():
        score = 0.0
        for before, word in zip(["\0", *ws], ws):
            above, below = level_count(pair[before, word]), level_count(single[before])
            relative = min(above / max(below, 1.0), 1.0) if below else 0.0
            score += math.log10(0.2 * relative + 0.8 * (level_count(single[word]) + 0.1) / norm)
        out[d] = score
    return out, total


def corpus():
    rng = random.Random(12)
    common = [sentence(rng, 12) for _ in range(30)]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < 0.7 else sentence(rng, 6) for _ in range(8))) for i in range(400)]
    return [*docs, (1000, None), (1001, ""), (1002, "WORD word"), (1003, docs[0][1])]


def test_scores_equal_exact_counts_where_no_probe_errs(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BITS", 400)
    docs = corpus()
    wanted, total = exact_scores(docs)
    got = {r["doc_id"]: r for r in bloom_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {r["train_tokens"] for r in got.values()} == {total}
    for d, score in wanted.items():
        assert got[d]["score"] == pytest.approx(score, abs=1e-6)


def test_scores_of_the_filter_as_used_stay_close(spark):
    docs = corpus()
    wanted, _ = exact_scores(docs)
    got = {r["doc_id"]: r for r in bloom_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    tokens = sum(r["n_tokens"] for r in got.values())
    # false probes are 2.4 % at 8 bits an entry: the mean token moves little
    assert sum(abs(got[d]["score"] - s) for d, s in wanted.items()) / tokens < 0.05
