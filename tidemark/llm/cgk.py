"""Benchmark decontamination by CGK embedding and bit-sampling locality-sensitive hashing.

A passage is an item when at most ``EDIT_PCT`` percent of the item's words must be
inserted, deleted or replaced to get it (word-level edit distance, A-Z lower-cased).

* Every text becomes a sequence of numbers of the items' words (0: any other word).
  Item-sized windows that hold too few item words, or too few of the rare ones, to be
  within the distance of any item of that size can't match; the others' starts remain.
  This test loses nothing.
* The CGK walk reads a window with a pointer that, at every step, emits the word under
  it and moves on or stays by a random bit of (step, word). Two sequences that differ by
  an edit fall into step again, so edit distance becomes Hamming distance.
* Items of like size share a walk that is no longer than the least of them. Each item has
  walks from anchors all along it, so edits that gather at its opening, middle or end leave
  others whole; a text has them from every item word in a window that passed the test above.
  ``REPEATS`` walks, each with ``SAMPLES`` sampled steps, give each place as many keys. An
  item without edits always shares them.
* What shares a key is verified exactly: the least edit distance between the item and
  any stretch of the text around the window. Places that point to one stretch are verified once.

The items are looked for in blocks of at most ``ITEM_BYTES`` of text each; only such a block is
broadcast, so memory is bounded however many items there are.

Nulls: null texts count as empty and hold nothing; null items are left out, as are items
of fewer than ``least_words`` words (an argument; 5 unless given), which say nothing about a
leak. Items of fewer than 5 words allow no edit, and every copy of them is found. Very long texts are
scanned whole. Ties: the leftmost best stretch counts; repeated rows get equal results;
repeated items are reported each. Empty tables give empty results. Extra columns are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import carried, restored, small_batches
from tidemark.llm.hashing import WordHasher, mixed

EDIT_PCT = 20
LEAST_WORDS = 5
REPEATS, SAMPLES = 12, 5
#: Steps of a walk at most, and how many anchors stand along the words that a walk covers.
STEPS, ANCHORS = 24, 4
ITEM_BYTES = 4 << 20
SEED = 11
#: Item sizes that share a filter, or a walk, differ by a factor of these at most.
CLASS_RATIO, WALK_RATIO = 1.15, 1.5


def edits_allowed(n: int) -> int:
    return n * EDIT_PCT // 100


def size_groups(sizes: set[int], ratio: float, top: int) -> list[list[int]]:
    """Sizes in ascending groups that differ by ``ratio`` at most; all from ``top`` on are one group."""
    groups: list[list[int]] = []
    for n in sorted(sizes):
        if groups and (n <= groups[-1][0] * ratio or groups[-1][0] >= top):
            groups[-1].append(n)
        else:
            groups.append([n])
    return groups


class Walks:
    """The walks of items of like size: their keys, and the item and anchor behind each."""

    def __init__(self, symbols: list[np.ndarray], members: list[int], codes: np.ndarray, moves: np.ndarray):
        self.codes, self.moves = codes, moves
        least = min(len(symbols[i]) for i in members)
        # no more steps than words: a walk over an unchanged item stays within it
        self.steps = min(least, STEPS)
        rng = np.random.default_rng(SEED + self.steps)
        size = min(SAMPLES, self.steps)
        self.sampled = np.sort([rng.choice(self.steps, size, replace=False) for _ in range(REPEATS)], axis=1)
        self.classes = []
        covered = self.steps // 2 + 1
        stride = max(1, covered // ANCHORS)
        items, anchors = [], []
        for i in members:
            last = max(0, len(symbols[i]) - covered) if edits_allowed(len(symbols[i])) else 0
            own = sorted({*range(0, last + 1, stride), last})
            items += [i] * len(own)
            anchors += own
        self.items, self.anchors = np.array(items), np.array(anchors)
        rows = np.zeros((len(items), self.steps + 1), np.int32)
        for row, i, at in zip(rows, items, anchors, strict=True):
            own = symbols[i][at : at + self.steps + 1]
            row[: len(own)] = own
        keys = self.embed(rows.ravel(), np.arange(len(rows)) * rows.shape[1]).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], np.tile(np.arange(len(rows), dtype=np.int32), REPEATS)[order]
        # most keys of a text are no item's: their first bits tell
        self.shift = np.uint64(64 - min(26, len(keys).bit_length() + 5))
        self.begun = np.zeros(1 << (64 - int(self.shift)), bool)
        self.begun[keys >> self.shift] = True

    def embed(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys (repeat x start) of the walks that begin at ``starts``."""
        out = np.empty((REPEATS, len(starts)), np.uint64)
        code = self.codes[symbols]
        for r in range(REPEATS):
            at, key = starts.copy(), np.full(len(starts), r, np.uint64)
            moves = self.moves[r][symbols].view(np.int64)
            chosen = set(self.sampled[r].tolist())
            for t in range(self.sampled[r][-1] + 1):
                if t in chosen:
                    key = mixed(key ^ code[at])
                at += (moves[at] >> t) & 1
            out[r] = key
        return out

    def shared(self, symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(where the item would begin, item) of what shares a key with some start."""
        for at in range(0, len(starts), 1 << 14):
            some = starts[at : at + (1 << 14)]
            low = int(some[0])
            keys = self.embed(symbols[low : int(some[-1]) + self.steps + 1], some - low)
            for own in keys:
                hit = np.flatnonzero(self.begun[own >> self.shift])
                first = np.searchsorted(self.keys, own[hit])
                counts = np.searchsorted(self.keys, own[hit], "right") - first
                places = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                owners = self.owners[places]
                yield np.repeat(some[hit], counts) - self.anchors[owners], self.items[owners]


class Items:
    """Items of a block, their vocabulary, filters and walks."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.vocabulary, numbers = np.unique(np.concatenate(self.words), return_inverse=True)
        ends = np.cumsum([len(w) for w in self.words])
        self.symbols = [x.astype(np.int32) + 1 for x in np.split(numbers, ends[:-1])]
        held = np.zeros(len(self.vocabulary) + 1, int)
        for s in self.symbols:
            held[np.unique(s)] += 1
        self.rare = held == 1
        sizes = np.array([len(s) for s in self.symbols])
        self.longest = int(sizes.max())
        self.gap = 2 * self.longest + STEPS + 1
        rng = np.random.default_rng(SEED)
        # bit t of a word's number tells whether step t of the walk moves on
        moves = rng.integers(0, 1 << 63, (REPEATS, len(held)), dtype=np.uint64)
        codes = rng.integers(0, 1 << 63, len(held), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.walks = []
        for group in size_groups(set(sizes.tolist()), WALK_RATIO, STEPS):
            walks = Walks(self.symbols, np.flatnonzero(np.isin(sizes, group)).tolist(), codes, moves)
            walks.classes = self._classes(group)
            self.walks.append(walks)

    def _classes(self, sizes: list[int]) -> list[tuple[int, int, int, int]]:
        """(window size, least distinct item words, least rare words, reach) by class of item sizes.

        An edit takes at most one distinct word away from what an item's first words and the
        window's have in common. Within the reach of a window's start its item ends.
        """
        out = []
        for group in size_groups(set(sizes), CLASS_RATIO, self.longest):
            size = group[0]
            own = [(s[:size], edits_allowed(len(s))) for s in self.symbols if len(s) in group]
            distinct = min(len(np.unique(s)) - allowed for s, allowed in own)
            rare = min(int(self.rare[np.unique(s)].sum()) - allowed for s, allowed in own)
            out.append((size, max(1, distinct), rare, group[-1] + edits_allowed(group[-1])))
        return out

    def open_starts(self, symbols: np.ndarray) -> Iterator[tuple[Walks, np.ndarray]]:
        """Item words in windows that hold enough of the items' words to match some item, by walk."""
        n = len(symbols)
        places = np.flatnonzero(symbols)
        if not len(places):
            return
        # where each known word stood before
        order = np.argsort(symbols[places], kind="stable")
        sorted_places = places[order]
        same = symbols[sorted_places[1:]] == symbols[sorted_places[:-1]]
        before = np.full(n, -1)
        before[sorted_places[1:][same]] = sorted_places[:-1][same]
        before = before[places]
        known = np.zeros(n + 1, np.int32)
        known[1:] = np.cumsum(symbols > 0)
        rare = np.zeros(n + 1, np.int32)
        rare[1:] = np.cumsum(self.rare[symbols])
        for walks in self.walks:
            edges = np.zeros(n + 1, np.int32)
            for size, least, least_rare, reach in walks.classes:
                # a word counts for the starts after its last occurrence, within the window's size
                first = np.maximum(before, places - size) + 1
                distinct = np.cumsum(np.bincount(first, minlength=n))[:n] - known[:n]
                ok = distinct[places] >= least
                if least_rare > 0:
                    ok &= rare[np.minimum(places + size, n)] - rare[places] >= least_rare
                opened = places[ok]
                edges[opened] += 1
                # starts differ, so ends do but for those past the last word
                edges[:n] -= np.bincount(opened[opened + reach < n] + reach, minlength=n).astype(np.int32)
            inside = places[np.cumsum(edges)[places] > 0]
            if len(inside):
                yield walks, inside

    def candidates(self, symbols: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, least, greatest begin) of stretches to verify, by item and place."""
        found = np.zeros(0, np.int64)
        base = len(self.symbols)
        for walks, starts in self.open_starts(symbols):
            held, size = [], 0
            for begin, item in walks.shared(symbols, starts):
                held.append(np.unique((begin + self.longest) * base + item))
                size += len(held[-1])
                if size > 1 << 20:
                    held = [np.unique(np.concatenate(held))]
                    size = 0
            found = np.unique(np.concatenate([found, *held]))
        items, begins = found % base, found // base - self.longest
        order = np.lexsort((begins, items))
        items, begins = items[order], begins[order]
        # what overlaps goes together
        sizes = np.array([len(s) for s in self.symbols])
        cut = np.flatnonzero((np.diff(items) != 0) | (np.diff(begins) > sizes[items[1:]])) + 1
        for own in np.split(np.arange(len(items)), cut):
            if len(own):
                yield int(items[own[0]]), int(begins[own[0]]), int(begins[own[-1]])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the items' words, 0 for others."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)

    def leaks(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
        """(item, distance, first word, end) of the best stretch of each item, for every text.

        The texts stand one after another, with gaps no window reaches across.
        """
        lengths = np.array([len(t) + self.gap for t in texts])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        symbols = np.zeros(offsets[-1], np.int32)
        for at, hashes in zip(offsets, texts):
            symbols[at : at + len(hashes)] = self.number(hashes)
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for item, least, greatest in self.candidates(symbols):
            # an item may begin before its text, but not by its length
            text = int(np.searchsorted(offsets, least + self.longest, "right")) - 1
            held = best[text].get(item)
            if held and held[0] == 0:
                continue
            own, offset = self.symbols[item], int(offsets[text])
            allowed = edits_allowed(len(own))
            low = max(offset, least - allowed)
            around = symbols[low : min(greatest + len(own) + 2 * allowed, offset + len(texts[text]))]
            if not could_match(own, around, allowed):
                continue
            distance, first, end = best_stretch(own, around, allowed)
            if distance <= allowed:
                found = (distance, low - offset + first, low - offset + end)
                best[text][item] = min(found, held or found)
        return [[(item, *found) for item, found in sorted(b.items())] for b in best]


def could_match(own: np.ndarray, around: np.ndarray, allowed: int) -> bool:
    """Enough of the item's words stand around, counted with repeats."""
    top = int(own.max()) + 1
    wanted = np.bincount(own, minlength=top)
    there = np.bincount(around[around < top], minlength=top)
    return int(np.minimum(wanted, there).sum()) >= len(own) - allowed


def best_stretch(own: np.ndarray, around: np.ndarray, allowed: int) -> tuple[int, int, int]:
    """Least edit distance of ``own`` to a stretch of ``around``, with its start and end.

    Sellers' recurrence, the row of all end places at once: insertions along a row are a
    running minimum. Starts follow from the same recurrence read backwards.
    """

    def last_row(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        places = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, int) if free else places.copy()
        for i, symbol in enumerate(a):
            step = np.empty(len(b) + 1, int)
            step[0] = i + 1
            np.minimum(row[1:] + 1, row[:-1] + (b != symbol), out=step[1:])
            row = np.minimum.accumulate(step - places) + places
        return row

    row = last_row(own, around, free=True)
    end = int(np.argmin(row))
    distance = int(row[end])
    if distance > allowed:
        return distance, 0, 0
    back = last_row(own[::-1], around[max(0, end - len(own) - allowed) : end][::-1], free=False)
    return distance, end - int(np.flatnonzero(back == distance)[0]), end


def item_blocks(items: DataFrame) -> Iterator[list]:
    """Rows (item_id, text) block by block, each of about ``ITEM_BYTES`` of text."""
    named = items.filter("text is not null").select("item_id", F.col("text").cast("string"))
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / ITEM_BYTES))
    for block in range(blocks):
        yield named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()


def prepared(rows: list, least_words: int = LEAST_WORDS) -> Items | None:
    hasher = WordHasher()
    hashed = [(r["item_id"], hasher(r["text"].encode())) for r in rows]
    hashed = [(i, w) for i, w in hashed if len(w) >= max(1, least_words)]
    return Items([i for i, _ in hashed], [w for _, w in hashed]) if hashed else None


def with_leaks(docs: DataFrame, items: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``leaks``: array of (item_id, distance, first_word, end_word) per row."""
    small_batches(docs.sparkSession)
    key = items.schema["item_id"].dataType.simpleString()
    kind = f"array<struct<item_id:{key},distance:int,first_word:int,end_word:int>>"
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(kind))
    for rows in item_blocks(items):
        block = prepared(rows, least_words)
        if block is None:
            continue
        # plain values travel: workers build the block from them
        shared = docs.sparkSession.sparkContext.broadcast((block.ids, block.words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hasher, block = WordHasher(), Items(*shared.value)
            for batch in batches:
                kind = batch.schema.field("leaks").type
                texts = [hasher(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
                found = []
                for before, own in zip(batch.column("leaks").to_pylist(), block.leaks(texts), strict=True):
                    new = [
                        {"item_id": block.ids[i], "distance": d, "first_word": a, "end_word": b} for i, d, a, b in own
                    ]
                    found.append(before + new)
                at = batch.schema.get_field_index("leaks")
                yield batch.set_column(at, batch.schema.field(at), pa.array(found, kind))

        out = out.mapInArrow(run, out.schema)
    return out


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no item, same columns."""
    found = with_leaks(carried(docs), items).filter(F.size("leaks") == 0)
    return restored(found, docs)
