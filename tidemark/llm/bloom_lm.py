"""A bigram language model whose counts sit in a log-frequency Bloom filter.

* Training counts unigrams and bigrams of all training texts (64-bit hashes). Tasks sum
  their share first; a sum travels in one row per task and bucket of the hash space.
* A gram seen c times has the level floor(log2(c)) + 1, be it a unigram or a bigram. For each
  level up to its own the filter holds the pair (gram, level). A count is read back by
  probing levels 1, 2, ... until one is absent, and stands for the middle of its level.
* A bucket of the hash space owns a segment of the filter, so the reducer that holds a
  bucket's counts sets its bits alone; the driver only lays segments end to end.
* The filter takes ``BITS`` bits an entry, however many there are, so a score means the
  same on any input. It is broadcast in groups of segments of ``filter_bytes`` at most; a
  task holds one group at a time and, when there are several, probes a block of texts
  against each in turn. A gram lies in one group. No gram is left out.
* Score: interpolation of the bigram's relative count with the smoothed unigram, both
  from probes. The base score uses exact counts: rows (word, block of texts) are joined
  with the words' sums, and dealt back to form the sums per text block by block.

Nulls: a null text counts as empty (one end token). A row without doc_id is scored but
not learned from, as held out. Very long texts are taken whole. Repeated rows are each
counted and each returned. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, sorted_groups, spread, written
from tidemark.llm.hashing import WordHasher, mixed

END = np.uint64(0x5851F42D4C957F2D)
BITS, HASHES = 8, 4
#: Bytes of the filter that a task holds at once, and of the texts that are probed together against several such groups.
FILTER_BYTES, PROBE_BYTES = 256 << 20, 16 << 20
#: Share of the bigram estimate; the unigram estimate has the rest.
BIGRAM_SHARE = 0.2
#: Texts whose words are summed together before they leave a task, and tokens likewise;
#: texts that are scored together.
BLOCK_BYTES, FLUSH_TOKENS, SCORE_BYTES = 8 << 20, 4 << 20, 4 << 20
#: Additive smoothing of the unigram estimates.
ADDED = 0.1


def held_out(key: str = "doc_id"):
    """Texts that aren't learned from: a tenth, by checksum of the id."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(10)) == 0, F.lit(True))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes, held_out and a row key: equal for equal rows only."""
    return docs.select(
        "doc_id",
        F.col("text").cast("string").cast("binary").alias("text"),
        held_out().alias("held_out"),
        F.xxhash64("doc_id", "text").alias("row_key"),
    )


def with_end(hashes: np.ndarray) -> np.ndarray:
    return np.append(hashes, END)


def bigrams(tokens: np.ndarray) -> np.ndarray:
    """Hashes of (previous token, token); before the first word stands the end token."""
    before = np.concatenate([[END], tokens[:-1]])
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def text_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= block_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


# exact counts ---------------------------------------------------------------------------


def packed_pairs(place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs as uint32, counts of over 255 in several, and where each one's end."""
    parts = (count + 254) // 255
    ends = np.cumsum(parts)
    high = place.astype(np.uint32) << np.uint32(8)
    pairs = np.repeat(high | np.uint32(255), parts)
    pairs[ends - 1] = high | (count - 255 * (parts - 1)).astype(np.uint32)
    return pairs, ends


def word_rows(docs: DataFrame) -> DataFrame:
    """(word, block, trained, texts): the texts of a block that hold a word, and how often it was trained on.

    ``texts`` are packed pairs (place in the block, count) of 24 and 8 bits; a larger count
    takes several. One more row per block has the row keys of its texts, under a word of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        part = TaskContext.get().partitionId() << 24
        for number, block in enumerate(text_blocks(batches)):
            tokens = [with_end(hasher(t)) for t in block.column("text").to_pylist()]
            place = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
            word = np.concatenate(tokens)
            order = np.argsort(word, kind="stable")
            word, place = word[order], place[order]
            new = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (place[1:] != place[:-1])])
            count = np.diff(np.r_[new, len(word)])
            word, place = word[new], place[new]
            learned = ~np.array(block.column("held_out").to_pylist(), bool)
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            trained = np.add.reduceat(count * learned[place], heads)
            pairs, ends = packed_pairs(place, count)
            offsets = (np.r_[0, ends][np.r_[heads, len(word)]] * 4).astype(np.int32)
            packs = pa.Array.from_buffers(
                pa.binary(), len(heads), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs.tobytes())]
            )
            own = np.array([part + number])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(word[heads].view(np.int64)),
                    pa.array(np.repeat(own, len(heads))),
                    pa.array(trained, pa.int64()),
                    packs,
                    pa.nulls(len(heads), pa.list_(pa.int64())),
                ],
                names,
            )
            keys = pa.array([block.column("row_key").to_pylist()], pa.list_(pa.int64()))
            apart = pa.array(mixed(own.astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [apart, pa.array(own), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), keys], names
            )

    names = ["word", "block", "trained", "texts", "keys"]
    return docs.mapInArrow(run, "word long, block long, trained long, texts binary, keys array<bigint>")


def counted_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, block, trained, texts, keys) rows and (word, n): each word's count over all training texts.

    Counts are added up in each task before they move, so a word that every block has costs
    a row per task.
    """
    rows = written(word_rows(docs), "words")
    return rows, written(rows.groupBy("word").agg(F.sum("trained").alias("n")), "counts")


def base_scores(rows: DataFrame, counts: DataFrame, total: int, distinct: int) -> DataFrame:
    """(row_key, n_known, base_score): exact unigram scores of every text.

    Rows meet their word's count in a join, which adaptive execution splits at a frequent
    word, and are then dealt back to their blocks, as many partitions as there are blocks.
    """
    norm = math.log10(total + ADDED * (distinct + 1))
    blocks = rows.where("keys IS NOT NULL").count()
    joined = rows.select("word", "block", "texts", "keys").join(counts, "word").drop("word")
    dealt = spread(joined, BLOCK_BYTES, blocks, "block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["block"]):
            keys = next(k for k in group.column("keys").to_pylist() if k is not None)
            words = group.filter(pc.is_valid(group.column("texts")))
            n = words.column("n").to_numpy()
            packs = words.column("texts").to_pylist()
            sizes = np.array([len(x) for x in packs]) // 4
            pairs = np.frombuffer(b"".join(packs), np.uint32)
            at, times = pairs >> np.uint32(8), pairs & np.uint32(255)
            scores = np.bincount(at, np.repeat(np.log10(n + ADDED) - norm, sizes) * times, len(keys))
            known = np.bincount(at, np.repeat(n > 0, sizes) * times, len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(known), pa.array(scores)], ["row_key", "n_known", "base_score"]
            )

    # equal rows have equal scores
    return dealt.mapInArrow(run, "row_key long, n_known long, base_score double").dropDuplicates(["row_key"])


# the filter -----------------------------------------------------------------------------


def _sums(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams)
    grams, counts = grams[order], counts[order]
    heads = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, int)
    return grams[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def canonical(grams: np.ndarray, bucket_bits: int) -> np.ndarray:
    """Grams cut to their bucket and the next 48 bits: what travels and what is looked up."""
    return grams & ~np.uint64((1 << (16 - bucket_bits)) - 1) if bucket_bits < 16 else grams


def packed(grams: np.ndarray, bucket_bits: int) -> bytes:
    """The 48 bits after the bucket's, 6 bytes each."""
    rest = (grams << np.uint64(bucket_bits)) >> np.uint64(16)
    return rest.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes, bucket: int, bucket_bits: int) -> np.ndarray:
    rest = np.zeros((len(data) // 6, 8), np.uint8)
    rest[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    low = (rest.view(np.uint64).ravel() << np.uint64(16)) >> np.uint64(bucket_bits)
    return low | (np.uint64(bucket) << np.uint64(64 - bucket_bits))


def gram_sums(docs: DataFrame, bucket_bits: int) -> DataFrame:
    """(bucket, kind, once, grams, counts): sums of a task's grams, as packed arrays.

    ``kind`` is 1 for unigrams and 2 for bigrams; ``once`` holds the grams met once, which
    travel without count. A bucket is the top bits of the hash.
    """

    def summed(kind: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        grams = canonical(np.concatenate(parts), bucket_bits)
        grams, counts = _sums(grams, np.ones(len(grams), np.int64))
        bucket = (grams >> np.uint64(64 - bucket_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        once, often, times = [], [], []
        for a, b in zip(cuts, np.r_[cuts[1:], len(grams)], strict=True):
            own, n = grams[a:b], counts[a:b]
            once.append(packed(own[n == 1], bucket_bits))
            often.append(packed(own[n > 1], bucket_bits))
            times.append(n[n > 1].astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts], pa.int64()),
                pa.array(np.full(len(cuts), kind), pa.int32()),
                *(pa.array(x, pa.binary()) for x in (once, often, times)),
            ],
            ["bucket", "kind", "once", "grams", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held: dict[int, list[np.ndarray]] = {1: [], 2: []}
        size = 0
        for batch in batches:
            for text, out in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist(), strict=True):
                if out:
                    continue
                tokens = with_end(hasher(text))
                held[1].append(tokens)
                held[2].append(bigrams(tokens))
                size += len(tokens)
            if size >= FLUSH_TOKENS:
                for kind in held:
                    yield summed(kind, held[kind])
                held, size = {1: [], 2: []}, 0
        if size:
            for kind in held:
                yield summed(kind, held[kind])

    schema = "bucket long, kind int, once binary, grams binary, counts binary"
    return docs.select("text", "held_out").mapInArrow(run, schema)


def positions(grams: np.ndarray, level: int, bits: np.ndarray) -> Iterator[np.ndarray]:
    """The places of (gram, level) within segments of ``bits`` bits, hash by hash."""
    h = mixed(grams ^ np.uint64(level * 0xA24BAED4963EE407 & ((1 << 64) - 1)))
    step = mixed(h) | np.uint64(1)
    for i in range(HASHES):
        yield ((h + np.uint64(i) * step) % bits).astype(np.int64)


def levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts)).astype(int) + 1


def segments(sums: DataFrame, bits_per_entry: float, bucket_bits: int) -> DataFrame:
    """(bucket, segment): the filter's bits of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket"]):
            bucket = group.column("bucket")[0].as_py()
            kinds = group.column("kind").to_numpy()
            entries = []
            for kind in (1, 2):
                grams, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for i in np.flatnonzero(kinds == kind).tolist():
                    once, often = (unpacked(group.column(c)[i].as_py(), bucket, bucket_bits) for c in ("once", "grams"))
                    times = np.frombuffer(group.column("counts")[i].as_py(), np.uint32)
                    grams += [once, often]
                    counts += [np.ones(len(once), np.int64), times.astype(np.int64)]
                found, times = _sums(np.concatenate(grams), np.concatenate(counts))
                entries.append((found, levels(times)))
            n = sum(int(level.sum()) for _, level in entries)
            bits = max(64, int(n * bits_per_entry) // 8 * 8)
            flags = np.zeros(bits, bool)
            for grams, level in entries:
                for j in range(1, int(level.max(initial=0)) + 1):
                    for at in positions(grams[level >= j], j, np.uint64(bits)):
                        flags[at] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int64()), pa.array([np.packbits(flags).tobytes()])], ["bucket", "segment"]
            )

    dealt = sums.repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(run, "bucket long, segment binary"), "segments")


class Filter:
    """Segments end to end, with the probing of counts."""

    def __init__(self, bucket_bits: int, rows: list):
        self.bucket_bits, self.shift = bucket_bits, np.uint64(64 - bucket_bits)
        sizes = np.zeros(1 << bucket_bits, np.int64)
        for bucket, segment in rows:
            sizes[bucket] = len(segment)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.bits = np.maximum(sizes * 8, 1).astype(np.uint64)
        self.empty = sizes == 0
        self.data = np.zeros(max(1, int(sizes.sum())), np.uint8)
        for bucket, segment in rows:
            self.data[self.starts[bucket] : self.starts[bucket] + len(segment)] = np.frombuffer(segment, np.uint8)

    def holds(self, grams: np.ndarray, level: int) -> np.ndarray:
        bucket = (grams >> self.shift).astype(np.int64)
        start, bits = self.starts[bucket], self.bits[bucket]
        alive = np.flatnonzero(~self.empty[bucket])
        h = mixed(grams ^ np.uint64(level * 0xA24BAED4963EE407 & ((1 << 64) - 1)))
        step = mixed(h) | np.uint64(1)
        for i in range(HASHES):
            at = ((h[alive] + np.uint64(i) * step[alive]) % bits[alive]).astype(np.int64)
            hit = (self.data[start[alive] + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8)) & 1
            alive = alive[hit > 0]
        out = np.zeros(len(grams), bool)
        out[alive] = True
        return out

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The highest level that is held, by repeated probes; 0 for grams of other segments."""
        grams = canonical(grams, self.bucket_bits)
        level = np.zeros(len(grams), int)
        open_ = np.flatnonzero(~self.empty[(grams >> self.shift).astype(np.int64)])
        j = 1
        while len(open_):
            open_ = open_[self.holds(grams[open_], j)]
            level[open_] = j
            j += 1
        return level

    def counts(self, grams: np.ndarray) -> np.ndarray:
        return counts_of(self.levels(grams))


class Groups:
    """A filter in groups of segments, of which one at a time is in memory."""

    def __init__(self, bucket_bits: int, shared: list):
        self.bucket_bits, self.shared = bucket_bits, shared
        self.only = self._filter(shared[0]) if len(shared) == 1 else None

    def _filter(self, group) -> Filter:
        found = Filter(self.bucket_bits, group.value)
        # the broadcast's rows are let go, and read again for the next block of texts
        vars(group).pop("_value", None)
        return found

    def levels(self, grams: np.ndarray) -> np.ndarray:
        if self.only:
            return self.only.levels(grams)
        level = np.zeros(len(grams), int)
        for group in self.shared:
            level += self._filter(group).levels(grams)
        return level


def segment_groups(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """First and last bucket of runs of segments of ``most`` bytes at most, from (bucket, bytes)."""
    out: list[tuple[int, int]] = []
    held = 0
    for bucket, size in sorted(sizes):
        if out and held + size <= most:
            out[-1], held = (out[-1][0], bucket), held + size
        else:
            out.append((bucket, bucket))
            held = size
    return out


def counts_of(level: np.ndarray) -> np.ndarray:
    """Counts by level: 1, then the level's geometric middle."""
    return np.where(level > 0, np.where(level == 1, 1.0, 2.0 ** (level - 0.5)), 0.0)


def score_tokens(tokens: list[np.ndarray], lookup: Filter | Groups, total: int, distinct: int) -> list[float]:
    """log10 probability of each token sequence; grams are looked up once a batch."""
    sizes = [len(t) for t in tokens]
    word = np.concatenate(tokens)
    pairs = np.concatenate([bigrams(t) for t in tokens])
    word_at, words = pd.factorize(word)
    gram_at, grams = pd.factorize(pairs)
    level = lookup.levels(np.concatenate([words, grams]))
    single = counts_of(level[: len(words)])[word_at]
    starts = np.cumsum([0, *sizes[:-1]])
    before = np.empty(len(word))
    before[1:] = single[:-1]
    # the last token of every text is the end token
    before[starts] = single[-1]
    pair = counts_of(level[len(words) :])[gram_at]
    unigram = (single + ADDED) / (total + ADDED * (distinct + 1))
    relative = np.where(before > 0, np.minimum(pair / np.maximum(before, 1.0), 1.0), 0.0)
    p = np.log10(BIGRAM_SHARE * relative + (1 - BIGRAM_SHARE) * unigram)
    return np.add.reduceat(p, starts).tolist()


def score(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row."""
    small_batches(docs.sparkSession)
    source = keyed(docs)
    rows, counts = counted_rows(source)
    distinct, total = counts.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    # about half a million tokens a bucket, whatever the corpus holds
    bucket_bits = max(6, math.ceil(math.log2(max(1, total) / 500_000)) + 1 if total > 500_000 else 6)
    sums = gram_sums(source, bucket_bits)
    built = segments(sums, BITS, bucket_bits)
    sizes = [tuple(r) for r in built.select("bucket", F.octet_length("segment")).collect()]
    shared = []
    for low, high in segment_groups(sizes, filter_bytes) or [(0, 0)]:
        found = built.filter(F.col("bucket").between(low, high)).toArrow()
        # plain values travel: workers build the filter from them
        rows_of = list(zip(found.column("bucket").to_pylist(), found.column("segment").to_pylist(), strict=True))
        shared.append(docs.sparkSession.sparkContext.broadcast(rows_of))
        del found, rows_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lookup = WordHasher(), Groups(bucket_bits, shared)
        for block in text_blocks(batches, SCORE_BYTES if lookup.only else PROBE_BYTES):
            if not block.num_rows:
                continue
            batch = block.combine_chunks().to_batches()[0]
            tokens = [with_end(hasher(t)) for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in ("doc_id", "held_out", "row_key")]
            columns += [
                pa.array([len(t) for t in tokens], pa.int64()),
                pa.array(score_tokens(tokens, lookup, total, distinct), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "row_key", "n_tokens", "score"])

    key = docs.schema["doc_id"].dataType.simpleString()
    kind = f"doc_id {key}, held_out boolean, row_key long, n_tokens long, score double"
    scored = source.mapInArrow(run, kind)
    base = written(base_scores(rows, counts, total, distinct), "base")
    return scored.join(base, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
