"""The operators with numpy in their tasks against brute force, round trips and held-out rows."""

import base64
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.conftest import PATTERN, RANKS, sentence
from tidemark.llm import bloom_lm, bpe, cgk, components, gam, html_crf, minhash, token_counts
from tidemark.llm.common import word_list
from tidemark.llm.hashing import WordHasher


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


# words ----------------------------------------------------------------------------------


def test_word_hashes_follow_the_words():
    hasher = WordHasher()
    seen = {}
    for text in ["a B\tb\x0bA é É", "", "  ", "x" * 3_000_000 + " y", "one two " * 300_000]:
        words, hashes = word_list(text), hasher(text.encode()).tolist()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# near duplicates ------------------------------------------------------------------------


def shingles(text):
    w = word_list(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(docs):
    sets = {d: shingles(t) for d, t in docs}
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    least = min(label[a], label[b])
                    changed |= label[a] != least or label[b] != least
                    label[a] = label[b] = least
    return label


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    docs = []
    for base in range(12):
        words = sentence(rng, 120).split()
        for copy in range(8):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                own[rng.randrange(len(own))] = sentence(rng, 1)
            docs.append((base * 10 + copy, " ".join(own)))
    docs += [(900, None), (901, ""), (902, "short text"), (903, "SHORT  text"), (904, "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("digest", F.lit("clash"))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    want = brute_components(docs)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == d) and r["n_shingles"] == len(shingles(dict(docs)[d])) for d, r in got.items())
    kept = minhash.keep_first(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["component_id"] for r in rows if r["doc_id"] == 5} == {1}
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# tokens ---------------------------------------------------------------------------------


def test_encoding_equals_the_library(spark, odd_docs, no_docs, reference):
    rng = random.Random(4)
    letters = "aAéß 中🎉\n\t'sdl!?0٣_-aaaa"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("tokens", F.lit(1))
    for docs in (df, odd_docs, no_docs):
        coded = bpe.encode(docs, RANKS, PATTERN)
        for row in bpe.decode(coded, RANKS).collect():
            assert row["tokens"] == reference.encode_ordinary(row["text"] or "") and row["round_trip"]
            assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_token_counts_by_rule(odd_docs, no_docs, reference):
    for rule in token_counts.RULES:
        rows = token_counts.count_tokens(odd_docs, RANKS, PATTERN, rule=rule).collect()
        assert len(rows) == odd_docs.count()
        texts = Counter(len(reference.encode_ordinary(r["text"] or "")) for r in odd_docs.collect())
        assert Counter(r["n_tokens"] for r in rows) == texts
        if rule != "middle":
            assert all(sum(c["n"] for c in r["counts"]) == pytest.approx(r["n_tokens"]) for r in rows)
    assert token_counts.count_tokens(no_docs, RANKS, PATTERN).count() == 0


def test_token_counts_of_fields(spark, reference):
    df = spark.createDataFrame([(1, "A title", None, "Body text here\n"), (2, "x", "y", "z")], "doc_id long, a string, b string, c string")
    text, sections = token_counts.field_sections({c: F.col(c) for c in "abc"})
    df = df.withColumns({"text": text, "spans": sections})
    for row in token_counts.count_tokens(df, RANKS, PATTERN, sections="spans").collect():
        body = "\n\n".join([row["a"], row["b"] or "", row["c"]])
        ids = reference.encode_ordinary(body)
        ends = np.cumsum([len(reference.decode([i])) for i in ids])
        starts = ends - [len(reference.decode([i])) for i in ids]
        for c in row["counts"]:
            assert c["n"] == sum(c["start"] <= s < c["end"] for s in starts)
            assert c["crossing"] == sum(c["start"] <= s < c["end"] < e for s, e in zip(starts, ends, strict=True))


# language model -------------------------------------------------------------------------


def test_scores(spark, odd_docs, no_docs):
    rng = random.Random(6)
    common = [sentence(rng, 30) for _ in range(10)]
    docs = [(i, rng.choice(common) + " " + sentence(rng, 5)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = {r["doc_id"]: r for r in bloom_lm.score(df).collect()}
    tokens = {d: [*word_list(t), "\0"] for d, t in docs}
    learned = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    total, distinct = sum(learned.values()), len(learned)
    for d, ws in tokens.items():
        base = sum(math.log10((learned[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert got[d]["base_score"] == pytest.approx(base) and got[d]["train_tokens"] == total
        assert (got[d]["n_tokens"], got[d]["n_known"]) == (len(ws), sum(learned[w] > 0 for w in ws))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    odd = bloom_lm.score(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in odd)
    assert bloom_lm.score(no_docs).count() == 0


def test_filter_reads_counts_back():
    rng = np.random.default_rng(1)
    grams = bloom_lm.canonical(rng.integers(0, 1 << 63, 3000, dtype=np.uint64), 6)
    assert (bloom_lm.unpacked(bloom_lm.packed(grams[:1], 6), int(grams[0] >> np.uint64(58)), 6) == grams[:1]).all()


def test_a_bigram_seen_once_counts(spark):
    # one text is learned from; a copy of it and its words in another order are held out
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = sentence(random.Random(4), 60).split()
    docs = [(ids[0], " ".join(words)), (held[0], " ".join(words)), (held[1], " ".join(sorted(words)))]
    got = {r["doc_id"]: r["score"] for r in bloom_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # each pair of the copy follows its word every time, so a token has 0.2 at least
    assert got[held[0]] >= 61 * math.log10(0.2 * 0.3) and got[held[0]] > got[held[1]] + 20


def test_scores_do_not_depend_on_the_memory_for_the_filter(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, sentence(rng, 200)) for i in range(300)], "doc_id long, text string")
    whole, parts = ({r["doc_id"]: r["score"] for r in bloom_lm.score(df, n).collect()} for n in (256 << 20, 8 << 10))
    assert whole == pytest.approx(parts)


# classifier -----------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark, odd_docs, no_docs):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        good = rng.random() < 0.6
        docs.append((i, sentence(rng, 60) if good else " ".join([sentence(rng, 1).upper() + "!!"] * 60)))
        labels.append((i, int(good)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("y", F.lit("clash"))
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    got = gam.classify(df, known).collect()
    truth = dict(labels)
    out = [r for r in got if r["held_out"]]
    assert out and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    odd = gam.classify(odd_docs, known).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in gam.classify(odd_docs, known.filter("false")).collect()} == {0.5}
    assert gam.classify(no_docs, known).count() == 0


def test_pairs_learn_what_features_alone_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


# pages ----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x="</p>";</script></head><body><nav><ul><li><a href=/>Home</a>
</ul></nav><!-- ad --><div class="ad">Buy now.</div><article><h1>A &amp; B</h1><p><b>One  line,
with break.<br><p>Two {n}.</p></article><div class="comments"><p>Nice post.</p></div><footer>&copy; me</footer></body></html>"""


def test_extraction(spark):
    pages = [(i, f"http://x/{i}", PAGE.replace("{n}", str(i))) for i in range(40)]
    pages += [(90, None, None), (91, "u", ""), (92, "u", "<p>unclosed <!-- comment"), (None, "u", PAGE), (None, "u", PAGE)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html_crf.extract(df).collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r["page_id"] is not None and r["page_id"] < 90:
            assert r["text"] == f"A & B\n\nOne line, with break.\n\nTwo {r['page_id']}." and r["n_chars"] == len(r["text"])
        if r["page_id"] in (90, 91):
            assert (r["text"], r["n_chars"]) == ("", 0)
    assert html_crf.extract(df.filter("false")).count() == 0


def test_viterbi_equals_all_labellings():
    rng = random.Random(1)
    for _ in range(40):
        names = [[rng.choice("abcd"), rng.choice("efgh")] for _ in range(rng.randint(1, 6))]
        field = html_crf.Field({c: rng.uniform(-2, 2) for c in "abcdefgh"}, [rng.random(), rng.random()], [[rng.random(), rng.random()], [rng.random(), rng.random()]])

        def score(labels, names=names, field=field):
            own = sum(field.weights[f] for fs, y in zip(names, labels, strict=True) if y for f in fs)
            return own + field.start[labels[0]] + sum(field.moves[a][b] for a, b in zip(labels, labels[1:], strict=False))

        every = [[(k >> i) & 1 for i in range(len(names))] for k in range(1 << len(names))]
        assert score(field.decode(names)) == pytest.approx(max(map(score, every)))


# decontamination ------------------------------------------------------------------------


def test_planted_passages_are_found(spark, odd_docs, no_docs):
    rng = random.Random(12)
    items = [(i, sentence(rng, rng.randint(15, 50))) for i in range(30)]
    docs, want = [], set()
    for i in range(400):
        words = sentence(rng, 80).split()
        if i % 4 == 0:
            item = rng.choice(items)
            own = item[1].split()
            for _ in range(len(own) // 10):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(80)
            words[at:at] = own
            want.add((i, item[0]))
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("leaks", F.lit("clash"))
    bench = spark.createDataFrame([*items, (None, None), (99, ""), (98, "the")], "item_id long, text string")
    found = {(r["doc_id"], x["item_id"]) for r in cgk.with_leaks(df, bench).collect() for x in r["leaks"]}
    assert found <= want and len(found) >= 0.97 * len(want)
    clean = cgk.keep_clean(df.drop("leaks"), bench)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in found}
    assert cgk.with_leaks(odd_docs, bench).count() == odd_docs.count()
    assert cgk.with_leaks(no_docs, bench).count() == 0
    assert cgk.keep_clean(odd_docs, bench.filter("false")).count() == odd_docs.count()


def test_stretch_distance_equals_brute_force():
    rng = random.Random(3)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(60):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(1, n))] for n in (6, 9))
        want = min(edits(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        got, first, end = cgk.best_stretch(np.array(a), np.array(b), 99)
        assert got == want == edits(a, b[first:end])
