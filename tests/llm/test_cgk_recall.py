"""Leaks wherever their edits gather, against an edit search through every stretch of the text."""

import random

import pytest

from tidemark.llm import cgk
from tidemark.llm.hashing import WordHasher

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "se", "to", "va", "ne") for b in ("ban", "dil", "for", "gus", "hen", "pir")]


def some(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def edited(rng, own, kind):
    n = len(own)
    edits, own = cgk.edits_allowed(n), list(own)
    first = {"opening": 0, "middle": (n - edits) // 2, "end": n - edits}.get(kind)
    places = rng.sample(range(n), edits) if first is None else range(first, first + edits)
    for p in sorted(places, reverse=True):
        if kind != "mixed" or rng.random() < 0.4:
            own[p] = rng.choice(WORDS) if rng.random() < 0.5 else f"new{rng.randrange(10**6)}"
        elif rng.random() < 0.5:
            del own[p]
        else:
            own.insert(p, rng.choice(WORDS))
    return own


def least_edits(item, text):
    """Sellers' table, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        last, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (word != other)))
    return min(row)


def hashed(words):
    return WordHasher()(" ".join(words).encode())


@pytest.mark.parametrize("sizes", [(15, 27, 40, 59), (5, 15, 40, 59), (5, 7, 11)])
def test_recall_against_every_stretch(sizes):
    rng = random.Random(sum(sizes))
    items = [some(rng, n) for n in sizes for _ in range(3)]
    block = cgk.prepared([{"item_id": i, "text": " ".join(w)} for i, w in enumerate(items)])
    for kind in ("opening", "middle", "end", "spread", "mixed"):
        texts = []
        for _ in range(2):
            texts += [some(rng, 20) + edited(rng, own, kind) + some(rng, 20) for own in items]
        got = block.leaks([hashed(t) for t in texts])
        hits = want = 0
        for text, found in zip(texts, got, strict=True):
            distances = {i: least_edits(own, text) for i, own in enumerate(items)}
            held = {i for i, d in distances.items() if d <= cgk.edits_allowed(len(items[i]))}
            assert {i for i, *_ in found} <= held
            assert all(d >= distances[i] for i, d, _, _ in found)
            want, hits = want + len(held), hits + len(found)
        assert want >= len(texts) and hits >= 0.95 * want, (kind, hits, want)


def test_items_below_five_words_are_matched_exactly():
    rng = random.Random(2)
    short = [["only"], ["two", "words"], ["three", "plain", "words"], ["four", "words", "all", "told"]]
    rows = [{"item_id": i, "text": " ".join(w)} for i, w in enumerate([*short, some(rng, 40)])]
    assert len(cgk.prepared(rows).ids) == 1 and cgk.prepared(rows[:4]) is None
    block = cgk.prepared(rows, least_words=1)
    texts = [own[:at] + some(rng, 9) + own + some(rng, 3) for own in short for at in (0, len(own) - 1)]
    for k, found in enumerate(block.leaks([hashed(t) for t in texts])):
        assert (k // 2, 0) in [(i, d) for i, d, _, _ in found]
    assert block.leaks([hashed(some(rng, 200)), hashed(["two", "new", "words"]), hashed([])]) == [[], [], []]


def test_a_very_long_text_full_of_an_item():
    rng = random.Random(3)
    item = some(rng, 30)
    block = cgk.prepared([{"item_id": 7, "text": " ".join(item)}])
    ((found,),) = block.leaks([hashed(some(rng, 5000) + item * 3000)])
    assert (found[0], found[1]) == (0, 0) and found[3] - found[2] == 30
