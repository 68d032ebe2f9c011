"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles, one feature after the other, on histograms of the
loss's gradients; a feature's trees add up to one table over its bins. Then the pairs
of features that explain most of what is left get tables over pairs of coarser bins,
boosted the same way. A score is the logistic of a constant plus one looked-up number
per feature and pair, added up by numpy for whole batches. Labels, language, source and
id are no inputs.

The model is fitted on the driver with at most ``SAMPLE`` labelled rows, the first by a
hash of their id; every document is scored. Rows whose crc32(doc_id) mod 3 is 1 are held
out and never fitted.

Nulls: a null text counts as empty and gets a score like any other; rows without
doc_id are scored and held out; null labels are not learned from. Without labels
every score is 0.5. Very long texts are taken whole. Repeated rows get equal scores; of
labels that repeat an id the least counts. Empty tables give empty results. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.llm.hashing import WordHasher, mixed

SAMPLE = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE, LEAVES, LEAST_ROWS, DAMPING = 0.1, 3, 20, 5.0

FEATURES = (
    "log_words", "mean_word", "upper", "digits", "punctuation", "marks", "symbols", "pipes", "exclamations",
    "not_ascii", "distinct_words", "repeated_next", "top_word", "distinct_windows", "words_a_line", "line_ends",
)


def codes_of(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


_UPPER, _LOWER = codes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), codes_of("abcdefghijklmnopqrstuvwxyz")
_DIGITS, _STOPS, _MARKS, _SYMBOLS = codes_of("0123456789"), codes_of(".,;:?"), codes_of("\"'()-"), codes_of("#*$%&<>@^~_=+")


def text_features(text: bytes | None, hasher: WordHasher) -> list[float]:
    """The numbers of ``FEATURES``; shares are of bytes, words or windows."""
    data = text or b""
    words = hasher(data)
    n, size = len(words), max(1, len(data))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, int)
    of = lambda codes: float(count[codes].sum()) / size
    upper = float(count[_UPPER].sum())
    if n:
        _, times = np.unique(words, return_counts=True)
        distinct, top = len(times) / n, times.max() / n
        again = float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0
    else:
        distinct, top, again = 1.0, 0.0, 0.0
    if n > 3:
        windows = mixed(mixed(words[:-2] * np.uint64(3) + words[1:-1]) + words[2:])
        fresh = len(np.unique(windows)) / len(windows)
    else:
        fresh = 1.0
    lines = int(count[10]) + 1
    ended = data.count(b".\n") + data.endswith(b".")
    return [
        float(np.log1p(n)),
        (size - int(count[[9, 10, 11, 12, 13, 32]].sum())) / max(1, n),
        upper / max(1.0, upper + float(count[_LOWER].sum())),
        of(_DIGITS),
        of(_STOPS),
        of(_MARKS),
        of(_SYMBOLS),
        float(count[ord("|")]) / max(1, n),
        float(count[ord("!")]) / max(1, n),
        float(count[128:].sum()) / size,
        distinct,
        again,
        float(top),
        fresh,
        n / lines,
        ended / lines,
    ]


class Model:
    """Edges of the bins, a table per feature, tables of pairs, and the constant."""

    def __init__(self, edges, tables, coarse, pairs, constant: float):
        self.edges, self.tables, self.coarse, self.pairs, self.constant = edges, tables, coarse, pairs, constant

    def plain(self) -> tuple:
        return self.edges, self.tables, self.coarse, self.pairs, self.constant

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.constant)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, j], "right")]
        if self.pairs:
            bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)]
            for i, j, table in self.pairs:
                total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def tree_on(gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Values over bins of a tree with ``LEAVES`` leaves at most: the best cuts of the histogram."""
    value = lambda a, b: gradient[a:b].sum() / (hessian[a:b].sum() + DAMPING)
    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for at, (a, b) in enumerate(leaves):
            if b - a < 2:
                continue
            g, h, n = (np.cumsum(x[a:b]) for x in (gradient, hessian, rows))
            gain = g[:-1] ** 2 / (h[:-1] + DAMPING) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + DAMPING)
            gain -= g[-1] ** 2 / (h[-1] + DAMPING)
            gain[(n[:-1] < LEAST_ROWS) | (n[-1] - n[:-1] < LEAST_ROWS)] = 0
            cut = int(np.argmax(gain))
            if gain[cut] > best[0]:
                best = (gain[cut], at, a + cut + 1)
        if best[1] is None:
            break
        a, b = leaves[best[1]]
        leaves[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(gradient))
    for a, b in leaves:
        out[a:b] = value(a, b)
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes of a pair's histogram: its gain, and the values over the bins."""
    cg, ch = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    part = lambda c: (
        c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1]
    )
    gs, hs = part(cg), part(ch)
    gain = sum(a * a / (b + DAMPING) for a, b in zip(gs, hs, strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g, dtype=float)
    values = [a[i, j] / (b[i, j] + DAMPING) for a, b in zip(gs, hs, strict=True)]
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one-feature tables, then of the chosen pairs' tables."""
    width = len(FEATURES)
    cuts = lambda j, bins: np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))
    if not len(x) or y.min() == y.max():
        flat = 0.0 if not len(x) else float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        none = [np.empty(0)] * width
        return Model(none, [np.zeros(1)] * width, none, [], flat)
    edges = [cuts(j, BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    constant = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(tables[j])
            found = RATE * tree_on(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n), np.bincount(bins[j], minlength=n))
            tables[j] += found
            total += found[bins[j]]
    coarse = [cuts(j, PAIR_BINS) for j in range(width)]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    sizes = [len(e) + 1 for e in coarse]

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        at, shape = rough[i] * sizes[j] + rough[j], (sizes[i], sizes[j])
        return tuple(np.bincount(at, v, sizes[i] * sizes[j]).reshape(shape) for v in (g, h))

    able = [(i, j) for i in range(width) for j in range(i) if sizes[i] > 1 and sizes[j] > 1]
    gains = {pair: quadrants(*histograms(*pair))[0] for pair in able}
    chosen = sorted(able, key=lambda pair: -gains[pair])[:PAIRS]
    pair_tables = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            found = RATE * quadrants(*histograms(i, j))[1]
            pair_tables[i, j] += found
            total += found[rough[i], rough[j]]
    return Model(edges, tables, coarse, [(i, j, t) for (i, j), t in pair_tables.items()], constant)


def is_held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(3)) == 1, F.lit(True))


def with_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, the features of each text."""
    small_batches(docs.sparkSession)
    chosen = docs.select(*keep, F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            x = pa.array([text_features(t, hasher) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), x], [*keep, "x"])

    return chosen.mapInArrow(run, chosen.select(*keep, F.array().cast("array<double>").alias("x")).schema)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Model:
    """The model of the bounded sample."""
    known = labels.filter(F.col(target).isNotNull() & ~is_held_out()).groupBy("doc_id").agg(F.min(target).alias("y"))
    # bounded by SAMPLE, so it may be broadcast
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # of several texts of an id the least, so that the model is the same each time
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    rows = with_features(texts, "doc_id", "y")
    found = rows.orderBy("doc_id").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, found["y"].to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    plain = train(docs, labels, target).plain()
    small_batches(docs.sparkSession)
    chosen = docs.select(
        "doc_id", is_held_out().alias("held_out"), F.col("text").cast("string").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = WordHasher(), Model(*plain)
        for batch in batches:
            if not batch.num_rows:
                continue
            score = model.score(np.array([text_features(t, hasher) for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {key}, held_out boolean, score double, predicted int")
