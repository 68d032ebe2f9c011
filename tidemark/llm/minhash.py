"""Near-duplicate groups: MinHash, banding, signature check, exact check, components.

1. Every text becomes the set of its 5-word shingles (64-bit hashes). One pass keeps the
   set's size and digest, ``BANDS * ROWS`` universal hash minima (a byte of each, for
   the signature check) and one key per band. Texts with equal sets form a class, which
   its least doc_id stands for from here on: exact copies cost one row each.
2. Band buckets with two members or more are kept. Each member is paired with its
   bucket's least member only; signatures filter the pairs, and each text's best one
   is confirmed on the full sets. Confirmed links give components.
3. Where a bucket still holds several components, the members of the smaller ones are
   compared with *all* members of the larger ones, block by block: signatures in numpy,
   then full sets, in the task, until a member is found linked. So every pair that shares
   a bucket and isn't in one component already is covered, no group of copies is ever
   expanded into its pairs, and a block's size is bounded.

At a similarity of 0.75 a pair shares none of the 50 buckets of 5 minima with a
probability of about 1e-6, and an estimate that low has one of about 1e-6.

Nulls: texts that are null or without words have an empty set and are linked with
nothing. A row without doc_id is returned as kept, without component. Repeated rows (equal
doc_id) count as one document. Very long texts are taken whole. Ties go to the least
doc_id. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches, sorted_groups, written
from tidemark.llm.components import components
from tidemark.llm.hashing import WordHasher, mixed

SHINGLE = 5
BANDS, ROWS = 50, 5
SEED = 20240229
#: Percentage of the union that two sets must share.
SIMILARITY = 75
#: Share of equal signature bytes below which a pair can't be similar enough.
LEAST_ESTIMATE = 0.62
#: Bits of 250 (the lowest of each minimum) that may differ: at 0.75 more do with a probability of 1e-6.
MOST_BITS = 56
#: Members of one side of a block comparison.
BLOCK = 500
#: Ids that are broadcast at most (8 bytes each); beyond, the same join shuffles.
BROADCAST_IDS = 4_000_000


class Shingler:
    """Shingle sets of texts."""

    def __init__(self):
        self.words = WordHasher()

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles; the whole sequence where it is shorter."""
        w = self.words(text)
        size = min(SHINGLE, len(w))
        if not size:
            return w
        n = len(w) - size + 1
        h = np.full(n, size, np.uint64)
        for j in range(size):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + n])
        return np.unique(h)


def universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` universal hash functions."""
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, (2, n), dtype=np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least high half of a*x+b over the set, for every function; in blocks that stay in cache."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        values = shingles[at : at + 256, None] * a
        values += b
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature bytes and band keys; null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (a, b) = Shingler(), universal(BANDS * ROWS)
        for batch in batches:
            sizes, digests, signatures, keys, bits = [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingler.shingles(text)
                sizes.append(len(found))
                if not len(found):
                    digests.append(None), signatures.append(None), keys.append(None), bits.append(None)
                    continue
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                least = minima(found, a, b)
                signatures.append((least & np.uint32(255)).astype(np.uint8).tobytes())
                band = np.arange(BANDS, dtype=np.uint64)
                for row in least.reshape(BANDS, ROWS).T.astype(np.uint64):
                    band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + row)
                keys.append(band.view(np.int64))
                lowest = np.zeros(-(-len(least) // 64) * 64, np.uint8)
                lowest[: len(least)] = least & np.uint32(1)
                bits.append(np.packbits(lowest).view(np.int64))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(bits, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "signature", "bands", "bits"])

    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, signature binary, bands array<bigint>, bits array<bigint>"
    )


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def check_signatures(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (u, v) whose signatures agree enough, with the share ``estimate``."""
    of = lambda c: reps.select(F.col("doc_id").alias(c), F.col("signature").alias(f"s_{c}"))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        share = (_bytes(batch.column("s_u")) == _bytes(batch.column("s_v"))).mean(axis=1)
        out = pa.RecordBatch.from_arrays(
            [batch.column("u"), batch.column("v"), pa.array(share)], ["u", "v", "estimate"]
        )
        return out.filter(pa.array(share >= LEAST_ESTIMATE))

    joined = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "s_u", "s_v")
    return map_batches(joined, "u long, v long, estimate double", compare)


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes) of the distinct ``ids``, once each."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    few = ids.count() <= BROADCAST_IDS
    chosen = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    return written(chosen.dropDuplicates(["doc_id"]), "texts")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * 100 < SIMILARITY * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= SIMILARITY * (len(a) + len(b) - shared)


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full shingle sets are similar enough."""
    of = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"t_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        last, last_set = None, None
        for batch in batches:
            good = []
            for i, hub in enumerate(batch.column("v").to_pylist()):
                if last != hub:
                    last, last_set = hub, shingler.shingles(batch.column("t_v")[i].as_py())
                good.append(similar(shingler.shingles(batch.column("t_u")[i].as_py()), last_set))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    small_batches(texts.sparkSession)
    joined = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "t_u", "t_v")
    return written(joined.mapInArrow(run, "u long, v long"), "links")


def across_components(multi: DataFrame, known: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) between different components, enough of them to join what belongs together.

    ``multi``: (key, rep) of buckets with several members; ``known``: (node, component).
    """
    sizes = known.groupBy("component").agg(F.count("*").alias("size"))
    nodes = reps.select(F.col("doc_id").alias("node"), "n_shingles", "bits").join(
        texts.select(F.col("doc_id").alias("node")), "node"
    )
    nodes = nodes.join(known, "node", "left").join(sizes, "component", "left")
    own = F.struct(F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("component", "node").alias("component"))
    nodes = written(nodes.select("node", own.alias("own"), "n_shingles", "bits"), "nodes")
    labelled = multi.select("key", "rep").join(nodes.withColumnRenamed("node", "rep"), "rep")
    several = labelled.groupBy("key").agg(F.max("own").alias("top"), F.min("own").alias("low")).filter("low < top")
    several = written(several.select("key", "top"), "several")
    rows = labelled.join(several, "key")
    parts = rows.groupBy("key", F.col("own").alias("other")).agg(
        F.count("*").alias("n"),
        F.min("n_shingles").alias("least"),
        F.max("n_shingles").alias("most"),
        F.min("bits").alias("bits"),
    )
    # only members of a bucket's smaller components look for others, in larger ones; sizes
    # and, of a component's one member here, bits rule out most that are too different
    small = rows.filter("own < top").select("key", "rep", "own", "n_shingles", F.col("bits").alias("own_bits"))
    differ = sum(
        F.bit_count(F.get("own_bits", F.lit(i)).bitwiseXOR(F.get("bits", F.lit(i)))) for i in range(-(-BANDS * ROWS // 64))
    )
    able = (
        (F.col("own") < F.col("other"))
        & (100 * F.col("n_shingles") >= SIMILARITY * F.col("least"))
        & (100 * F.col("most") >= SIMILARITY * F.col("n_shingles"))
        & ((F.col("n") > 1) | (differ <= MOST_BITS))
    )
    seekers = small.join(parts.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & able).select(
        F.col("rep").alias("node"), F.col("other.component").alias("target"), F.col("other.size").alias("size")
    )
    seekers = written(seekers.distinct(), "seekers")
    wanted = seekers.groupBy("target").agg(F.count("*").alias("n"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    all_blocks = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    own_block = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    members = nodes.select("node", F.col("own.component").alias("target"), "own.size")
    members = members.join(written(wanted, "wanted"), "target")
    left = members.select("target", own_block("size").alias("a"), all_blocks("n").alias("b"), F.lit(0).alias("side"), "node")
    right = seekers.join(wanted, "target").select(
        "target", all_blocks("size").alias("a"), own_block("n").alias("b"), F.lit(1).alias("side"), "node"
    )
    payload = texts.join(reps.select("doc_id", "signature"), "doc_id").withColumnRenamed("doc_id", "node")
    rows = left.unionByName(right).join(payload, "node")
    ids = ["target", "a", "b"]
    dealt = rows.repartition(*ids).sortWithinPartitions(*ids, "side", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for group in sorted_groups(batches, ids):
            yield compare_sides(group, shingler)

    small_batches(multi.sparkSession)
    return written(dealt.mapInArrow(run, "u long, v long"), "links")


def compare_sides(group: pa.Table, shingler: Shingler) -> pa.RecordBatch:
    """For each seeker of a block one member of the target that it is linked with, if there is one."""
    side, node = group.column("side").to_numpy(), group.column("node").to_pylist()
    signature, text = _bytes(group.column("signature")), group.column("text")
    sets: dict[int, np.ndarray] = {}

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingler.shingles(text[i].as_py())
        return sets[i]

    members = np.flatnonzero(side == 0)
    us, vs = [], []
    for i in np.flatnonzero(side == 1).tolist():
        share = (signature[members] == signature[i]).mean(axis=1)
        near = np.flatnonzero(share >= LEAST_ESTIMATE)
        for j in members[near[np.argsort(-share[near], kind="stable")]].tolist():
            if similar(of(i), of(j)):
                us.append(node[i])
                vs.append(node[j])
                break
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id: one row per row of ``docs``."""
    sketched = written(sketch(docs), "sketch")
    named = sketched.filter("digest is not null and doc_id is not null")
    classes = written(named.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    heads = named.select("doc_id", "n_shingles", "signature", "bands", "bits").join(classes.select(F.col("rep").alias("doc_id")), "doc_id")
    reps = written(heads.dropDuplicates(["doc_id"]), "reps")
    banded = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"))
    # hubs are written, so that the join below reads plain exchanges and splits hot buckets
    hubs = written(
        banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n"), "hubs"
    )
    multi = written(banded.join(hubs, "key"), "multi")
    pairs = multi.filter("rep <> hub").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct()
    signatures = reps.select("doc_id", "n_shingles", "signature", "bits")
    best = (
        check_signatures(pairs, signatures)
        .groupBy("u")
        .agg(F.max(F.struct("estimate", (-F.col("v")).alias("least")))["least"].alias("least"))
        .select("u", (-F.col("least")).alias("v"))
    )
    texts = texts_of(multi.select(F.col("rep").alias("doc_id")).distinct(), docs)
    links = confirm(best, texts)
    known = written(components(links), "components")
    more = across_components(multi, known, signatures, texts)
    if not more.isEmpty():
        known = components(links.unionByName(more))
    labels = classes.join(known.withColumnRenamed("node", "rep"), "rep", "left")
    labels = written(
        labels.select("digest", F.coalesce("component", "rep").alias("component"), F.col("rep").alias("class_id")),
        "labels",
    )
    found = sketched.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stand for their group, same columns."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = written(gone, "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti").select(*docs.columns)
