"""The prefix trie of conversations by splitter skeleton and local sorted shards.

A conversation is a path: 20 bytes a turn, a digest of role and text and the text's code
points. Equal paths are counted before anything moves, and distinct paths are dealt out by
ranges of their order. A node's subtree is one stretch of that order, so it lies within one
shard unless a splitter stands inside it, and then the node is a prefix of the splitter: the
*skeleton*, the trie of the splitters' prefixes, holds every node that several shards share.
It is broadcast. Each shard walks its sorted paths with a stack and finishes all other nodes;
of a skeleton node it gives a partial sum, and these are added up by node, then along the
skeleton from each node to its ancestors.

Bounds: at most ``MOST_SHARDS`` splitters of at most ``DEEPEST`` turns, taken from a hashed
sample of at most about ``SAMPLE`` paths (it decides where shards begin, never what is
counted), so the skeleton has at most their product of nodes. A task holds the stack of one
path and, for its open nodes, the finished children that wait for the parent's least member.
A conversation is one value of 20 bytes a turn. The members that end at one node are hashed in
their order by one task, as a digest of a sequence asks for, from a sorted stream of 24 bytes
a member.

Nulls: rows without conv_id are left out; a null role or text counts as empty; null turns
come first, equal turns go by the digest of role and text. Long texts count whole. An empty
table gives an empty result. Only the four columns are read, whatever others are there.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, sorted_groups, written

#: Bytes of a turn in a path: 16 of digest, 4 of code points.
UNIT = 20
#: Shared turns at most, and every so many conversations have one base.
MOST_HEAD, BASE_EVERY = 5, 100

SHARD_BYTES = 8 << 20
MOST_SHARDS = 2048
#: Turns of a splitter at most; paths that agree on more stay in one shard.
DEEPEST = 32
SAMPLE = 8192
#: Sampled paths for each shard, so that shards differ little in size.
OVER = 32

NO_ENDS = hashlib.sha256(b"").hexdigest()


def unit(role: Column, text: Column) -> Column:
    """A turn as hex text of fixed width."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(told, 256), 1, 32), F.lpad(F.lower(F.hex(F.length(text))), 8, "0"))


def own_paths(conversations: DataFrame) -> DataFrame:
    """conv_id and path, the conversation's turns in order."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        unit(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("unit"),
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "unit")
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("turns"))
    return turns.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["unit"]), "")).alias("path")
    )


def rebuilt_paths(own: DataFrame) -> DataFrame:
    """Every conversation c with the first crc32(c) % 6 turns of conversation c - c % 100 in place of its own."""
    base = F.col("conv_id") - F.col("conv_id") % BASE_EVERY
    heads = own.where(F.col("conv_id") % BASE_EVERY == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, MOST_HEAD * UNIT).alias("head")
    )
    taken = (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % (MOST_HEAD + 1)).cast("int") * UNIT
    none = F.lit(bytearray())
    head = F.coalesce(F.substr("head", F.lit(1), taken), none)
    rest = F.substr("path", taken + 1, F.greatest(F.octet_length("path") - taken, F.lit(0)))
    return own.withColumn("base", base).join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("path"))


def ends_of(members: DataFrame) -> DataFrame:
    """``members`` (pid, conv_id) to (pid, ends): the digest of each path's conv_ids in ascending order."""
    ordered = members.repartition("pid").sortWithinPartitions("pid", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            for group in sorted_groups(iter([batch]), ["pid"]):
                pid = group.column("pid")[0].as_py()
                ids = ",".join(map(str, group.column("conv_id").to_pylist()))
                if pid == held:
                    digest.update(b"," + ids.encode())
                    continue
                if held is not None:
                    out.append((held, digest.hexdigest()))
                held, digest = pid, hashlib.sha256(ids.encode())
            if out:
                yield _pairs(out)
        if held is not None:
            yield _pairs([(held, digest.hexdigest())])

    return ordered.mapInArrow(run, "pid binary, ends string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    pids, ends = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(pids, pa.binary()), pa.array(ends)], ["pid", "ends"])


def distinct_paths(paths: DataFrame) -> DataFrame:
    """path, n, conv_id (the least) and ends of every distinct path."""
    pid = F.substring(F.unhex(F.sha2(F.col("path"), 256)), 1, 16).alias("pid")
    counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    counts = counts.withColumn("pid", pid)
    shared = counts.where("n > 1").select("pid")
    ends = ends_of(paths.select(pid, "conv_id").join(shared, "pid", "left_semi"))
    alone = F.sha2(F.col("conv_id").cast("string"), 256)
    return counts.join(ends, "pid", "left").select("path", "n", "conv_id", F.coalesce("ends", alone).alias("ends"))


def choose_splitters(sample: list[bytes], shards: int) -> list[bytes]:
    """At most ``shards - 1`` paths, each cut to what sets it apart from the sampled path before it."""
    found = set()
    sample = sorted(set(sample))
    for i in range(1, shards):
        at = i * len(sample) // shards
        if at:
            same = shared_turns(sample[at - 1], sample[at])
            found.add(sample[at][: (same + 1) * UNIT])
    return sorted(found)


def shared_turns(a: bytes, b: bytes) -> int:
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least // UNIT
    low, high = 0, least // UNIT  # the first unequal turn lies in [low, high)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * UNIT : mid * UNIT] == b[low * UNIT : mid * UNIT]:
            low = mid
        else:
            high = mid
    return low


class Skeleton:
    """The trie of the splitters' proper prefixes; node 0 is the root."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.children: list[dict[bytes, int]] = [{}]
        self.ancestors: list[list[int]] = [[]]
        for path in splitters:
            at = 0
            for start in range(0, len(path) - UNIT, UNIT):
                step = path[start : start + UNIT]
                if step not in self.children[at]:
                    self.children[at][step] = len(self.children)
                    self.children.append({})
                    self.ancestors.append([*self.ancestors[at], at])
                at = self.children[at][step]

    def shard(self, path: bytes) -> int:
        return bisect_right(self.splitters, path)


class Node:
    """An open node of a walk; ``waiting`` are finished children without their parent's conv_id."""

    __slots__ = ("skeleton", "chars", "n", "conv_id", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skeleton: int, chars: int):
        self.skeleton, self.chars = skeleton, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.conv_id = self.ends = None
        self.waiting: list[tuple] = []

    def take(self, n: int, conv_id: int) -> None:
        self.n += n
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)


#: What a walk gives: finished nodes, and partial sums of skeleton nodes, which have ``node``.
WALKED = {
    "node": pa.int32(), "parent_node": pa.int32(), "conv_id": pa.int64(), "depth": pa.int64(),
    "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "chars": pa.int64(),
}
WALKED_DDL = ", ".join(
    f"{name} {({pa.int32(): 'int', pa.int64(): 'long', pa.string(): 'string'})[kind]}" for name, kind in WALKED.items()
)


class Walk:
    """The nodes of sorted paths, by a stack of those that are still open."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.stack, self.path, self.out = skeleton, [Node(0, 0)], b"", []

    def add(self, path: bytes, n: int, conv_id: int, ends: str) -> None:
        same = shared_turns(self.path, path)
        while len(self.stack) > same + 1:
            self.close()
        for start in range(same * UNIT, len(path), UNIT):
            step, above = path[start : start + UNIT], self.stack[-1].skeleton
            known = self.skeleton.children[above].get(step, -1) if above >= 0 else -1
            self.stack.append(Node(known, int.from_bytes(step[16:], "big")))
        top = self.stack[-1]
        top.take(n, conv_id)
        top.ends = ends
        self.path = path

    def close(self) -> None:
        x, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if x.skeleton >= 0:
            self.out.append(
                (x.skeleton, None, x.conv_id, depth, None, x.n, x.children, x.leaves, x.saved, x.ends, x.chars)
            )
        else:
            x.leaves = x.leaves or 1
            x.saved += (x.n - 1) * x.chars
            self.out += [(*row[:4], x.conv_id, *row[5:]) for row in x.waiting]
            known = above.skeleton if above.skeleton >= 0 else None
            row = (None, known, x.conv_id, depth, None, x.n, x.children, x.leaves, x.saved, x.ends or NO_ENDS, x.chars)
            (self.out if known is not None else above.waiting).append(row)
            above.children += 1
        if above is not None:
            above.take(x.n, x.conv_id)
            above.leaves += x.leaves
            above.saved += x.saved

    def told(self) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.out), 4096):
            columns = zip(*self.out[start : start + 4096], strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, WALKED.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, list(WALKED))
        self.out = []


def walk_shards(paths: DataFrame, shards: int, sample: list[bytes]) -> tuple[DataFrame, Skeleton]:
    """Nodes and partial sums of all distinct ``paths``, and the skeleton they belong to."""
    skeleton = Skeleton(choose_splitters(sample, shards))
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = shared.value.shard
        for batch in batches:
            numbers = [shard(p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("shard", pa.array(numbers, pa.int32()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, seen = Walk(shared.value), False
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "conv_id", "ends")), strict=True):
                walk.add(*row)
                seen = True
            if len(walk.out) >= 4096:
                yield from walk.told()
        while seen and walk.stack:
            walk.close()
        yield from walk.told()

    dealt = paths.select("path", "n", "conv_id", "ends").mapInArrow(
        deal, "path binary, n long, conv_id long, ends string, shard int"
    )
    sorted_shards = dealt.repartitionById(shards, "shard").sortWithinPartitions("path")
    return sorted_shards.mapInArrow(walk, WALKED_DDL), skeleton


def skeleton_nodes(partial: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Whole sums of the skeleton's nodes, with ``node``, from their shards' partial sums."""
    tree = partial.sparkSession.createDataFrame(
        [(i, above[-1] if above else None, [*above, i]) for i, above in enumerate(skeleton.ancestors)],
        "node int, above int, line array<int>",
    )
    sums = partial.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("chars").alias("chars"),
    )
    # at most MOST_SHARDS * DEEPEST rows, so these joins may broadcast
    nodes = sums.join(F.broadcast(tree), "node")
    below = nodes.where("above IS NOT NULL").groupBy(F.col("above").alias("node")).agg(F.count(F.lit(1)).alias("below"))
    nodes = nodes.join(F.broadcast(below), "node", "left")
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.coalesce("below", F.lit(0)))
    own = nodes.select(
        F.explode("line").alias("node"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
    )
    own = own.groupBy("node").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    parents = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(F.broadcast(own), "node")
        .join(F.broadcast(parents), "above", "left")
        .withColumns(
            {
                "n_leaves": F.col("n_leaves") + F.col("own_leaf"),
                "saved_tokens": F.col("saved_tokens") + F.col("own_saved"),
                "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS)),
            }
        )
    )


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every node of the trie of ``paths`` (conv_id long, path binary, one row per conversation)."""
    spark = paths.sparkSession
    small_batches(spark)
    groups = written(distinct_paths(paths), "trie-paths")
    told = groups.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("path") + 100).alias("bytes")).first()
    shards = min(MOST_SHARDS, max(spark.sparkContext.defaultParallelism, math.ceil((told["bytes"] or 0) / shard_bytes)))
    share = min(1.0, min(SAMPLE, OVER * shards) / max(told["n"], 1))
    picked = groups.where(F.pmod(F.xxhash64("path"), F.lit(1 << 32)) < int(share * (1 << 32)))
    sample = [bytes(r[0]) for r in picked.select(F.substring("path", 1, DEEPEST * UNIT)).collect()]
    walked, skeleton = walk_shards(groups, shards, sample)
    walked = written(walked, "trie-nodes")
    top = written(skeleton_nodes(walked.where("node IS NOT NULL"), skeleton), "trie-skeleton")
    above = top.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("top_conv_id"))
    finished = (
        walked.where("node IS NULL")
        .join(F.broadcast(above), "parent_node", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv_id"))
    )
    return finished.select(*RESULT).unionByName(top.select(*RESULT))


def conversation_trie(conversations: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The trie of all rebuilt conversations."""
    own = written(own_paths(conversations), "trie-own")
    return trie(written(rebuilt_paths(own), "trie-rebuilt"), shard_bytes)
