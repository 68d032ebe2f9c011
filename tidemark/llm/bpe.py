"""Byte-level BPE by corpus-level merge replay, and its inverse.

Spark deals out the texts; a task works through its share in blocks of the corpus
(``BLOCK_CHARS`` characters at least). The distinct pre-tokens of a block that were not
met before are laid out one after another as linked lists of byte symbols, and an
inverted index maps every adjacent pair that merges to the places where it stands.
Merges are then replayed in rank order over the whole block: popping a rank visits
only the indexed places, and each merge re-indexes its two neighbours only. A document's
tokens are its pre-tokens' sequences, looked up; sequences are kept as bytes of int32. No
merge reaches over the end of a pre-token, so a block's replay gives what one over the
whole corpus would, without shuffling every distinct pre-token to and fro. Nothing is shuffled and nothing that
grows with the corpus is broadcast: the rank table has the size of the vocabulary.

Nulls: a null text counts as empty; empty texts have no tokens. Very long texts are cut,
for splitting only, between a word and a single space, where pre-tokens always end.
Repeated rows and ties get equal results; empty tables give empty results. Extra
columns are carried through; one that has the name of a result is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_lists, small_batches

#: Distinct pre-tokens are gathered over so many characters before their merges are replayed.
BLOCK_CHARS = 2 << 20
#: Texts longer than this are split into pre-tokens piece by piece.
PIECE_CHARS = 1 << 20
#: Bytes of pre-tokens and their sequences that a task remembers from block to block, with
#: what Python adds to each.
REMEMBERED_BYTES, ENTRY_BYTES = 80 << 20, 190


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank; the rank is the token id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    token = [b""] * (max(ranks.values()) + 1)
    for name, rank in ranks.items():
        token[rank] = name
    return token


def decode(encoded: DataFrame, path: str, tokens: str = "tokens") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the token ids; null where those are null."""
    small_batches(encoded.sparkSession)
    ranks = _ranks(encoded, path)
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_table(ranks.value)
        for batch in batches:
            ids = batch.column(tokens).to_pylist()
            values = [None if x is None else decode_bytes(x, token) for x in ids]
            yield batch.append_column("decoded", pa.array(values, pa.binary()))

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit(b"")).schema)


class Merger:
    """Replays the merges of a rank table over sets of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = token_table(ranks)
        self.width = len(self.token)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
        #: (left id * width + right id) to the merged id, -1 where the pair doesn't merge
        self.pairs: dict[int, int] = {}
        two = np.full((256, 256), -1)
        for name, rank in ranks.items():
            if len(name) == 2:
                two[name[0], name[1]] = rank
        self.byte_pairs = two

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids of every word as int32 bytes: all merges in rank order over all words at once."""
        out = [array("i", [self.ranks[w]] if w in self.ranks else []) for w in words]
        open_words = [i for i, w in enumerate(words) if w and not out[i]]
        symbols = np.frombuffer(b"".join(words[i] for i in open_words), np.uint8)
        if not len(symbols):
            return [ids.tobytes() for ids in out]
        ends = np.cumsum([len(words[i]) for i in open_words])
        places = np.arange(len(symbols))
        follow = places + 1
        follow[ends - 1] = -1
        lead = places - 1
        lead[np.r_[0, ends[:-1]]] = -1
        # the index at the start: rank of each adjacent byte pair, places in ascending order
        rank_at = np.full(len(symbols), -1)
        rank_at[:-1] = self.byte_pairs[symbols[:-1], symbols[1:]]
        rank_at[ends - 1] = -1
        at = np.flatnonzero(rank_at >= 0)
        at = at[np.argsort(rank_at[at], kind="stable")]
        heap, starts = np.unique(rank_at[at], return_index=True)
        index = dict(zip(heap.tolist(), (x.tolist() for x in np.split(at, starts[1:])), strict=True)) if len(at) else {}
        ids, after, before = self.byte_ids[symbols].tolist(), follow.tolist(), lead.tolist()
        self._merge(ids, after, before, index, rank_at.tolist())
        for i, p in zip(open_words, np.r_[0, ends[:-1]].tolist(), strict=True):
            word = out[i]
            while p >= 0:
                word.append(ids[p])
                p = after[p]
        return [ids.tobytes() for ids in out]

    def _merge(self, ids, after, before, index, rank_at) -> None:
        """``rank_at``: what the pair that begins at a place merges to now; stale index entries differ."""
        pairs, width = self.pairs, self.width
        heap = sorted(index)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            places.sort()
            for i, p in enumerate(places):
                if rank_at[p] != rank:
                    continue  # a merge since then has taken one of the two
                q = after[p]
                follow = after[q]
                ids[p] = rank
                rank_at[q] = -1
                after[p] = follow
                lower = False
                if follow >= 0:
                    before[follow] = p
                    key = rank * width + ids[follow]
                    found = pairs.get(key)
                    if found is None:
                        found = self._learn(key)
                    rank_at[p] = found
                    if found >= 0:
                        if found in index:
                            index[found].append(p)
                        else:
                            index[found] = [p]
                            heapq.heappush(heap, found)
                            lower = found < rank
                else:
                    rank_at[p] = -1
                p0 = before[p]
                if p0 >= 0:
                    key = ids[p0] * width + rank
                    found = pairs.get(key)
                    if found is None:
                        found = self._learn(key)
                    rank_at[p0] = found
                    if found >= 0:
                        if found in index:
                            index[found].append(p0)
                        else:
                            index[found] = [p0]
                            heapq.heappush(heap, found)
                            lower = lower or found < rank
                if lower:
                    # a lower rank came up: it goes first, the other places of this rank wait
                    index.setdefault(rank, []).extend(places[i + 1 :])
                    heapq.heappush(heap, rank)
                    break

    def _learn(self, key: int) -> int:
        left, right = divmod(key, self.width)
        found = self.pairs[key] = self.ranks.get(self.token[left] + self.token[right], -1)
        return found


class Encoder:
    """Encodes blocks of texts, remembering sequences of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merger, self.split = Merger(ranks), regex.compile(pattern)
        self.cut = regex.compile(r"(?<=\S) (?=\S)")
        self.known: dict[str, bytes] = {}
        self.size = 0

    def pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PIECE_CHARS and (cut := self.cut.search(text, start + PIECE_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def words(self, text: str | None) -> Iterator[list[str]]:
        """The pre-tokens of a text, piece by piece."""
        return map(self.split.findall, self.pieces(text)) if text else iter(())

    def learn(self, words: Iterable[str]) -> None:
        """Replay the merges over those pre-tokens that aren't known."""
        if self.size > REMEMBERED_BYTES:
            self.known.clear()
            self.size = 0
        new = [w for w in words if w not in self.known]
        found = self.merger.replay([w.encode() for w in new])
        self.known.update(zip(new, found, strict=True))
        self.size += len(new) * ENTRY_BYTES + 2 * sum(map(len, new)) + sum(map(len, found))

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Token ids of each text of a block, as int32 bytes."""
        split = [[words for words in self.words(text)] for text in texts]
        met: set[str] = set()
        for pieces in split:
            met.update(*pieces)
        self.learn(met)
        del met
        known = self.known.__getitem__
        for i, pieces in enumerate(split):
            yield b"".join(b"".join(map(known, words)) for words in pieces)
            split[i] = []


def blocks(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[list[pa.RecordBatch]]:
    """Runs of batches that make up a block of the corpus."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded_batches(
    batches: Iterable[pa.RecordBatch], encoder: Encoder, text: str
) -> Iterator[tuple[pa.RecordBatch, list[str | None], list[bytes]]]:
    """Every batch with its texts and their ids, block by block."""
    for block in blocks(batches, text):
        coded = encoder([value for batch in block for value in batch.column(text).to_pylist()])
        while block:
            batch = block.pop(0)
            yield batch, batch.column(text).to_pylist(), list(islice(coded, batch.num_rows))


def _ranks(df: DataFrame, path: str):
    """The rank table for all tasks; as large as the vocabulary file, whatever the corpus."""
    return df.sparkSession.sparkContext.broadcast(load_ranks(path))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens``, the ids of each text, and ``round_trip``: they decode to its bytes."""
    small_batches(docs.sparkSession)
    ranks = _ranks(docs, path)
    docs = docs.drop("tokens", "round_trip")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token = Encoder(ranks.value, pattern), token_table(ranks.value)
        for batch, texts, coded in encoded_batches(batches, encoder, text):
            same = [
                decode_bytes(memoryview(ids).cast("i").tolist(), token) == (value or "").encode()
                for ids, value in zip(coded, texts, strict=True)
            ]
            yield batch.append_column("tokens", id_lists(coded)).append_column("round_trip", pa.array(same, pa.bool_()))

    out = docs.withColumns({"tokens": F.array().cast("array<int>"), "round_trip": F.lit(True)})
    return docs.mapInArrow(run, out.schema)


def decode_bytes(ids: list[int], token: list[bytes]) -> bytes:
    return b"".join(map(token.__getitem__, ids))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them.

    Encoding and decoding run in one pass, so that the ids need not leave the task.
    """
    small_batches(docs.sparkSession)
    ranks = _ranks(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token = Encoder(ranks.value, pattern), token_table(ranks.value)
        name = [str(i) for i in range(len(token))]
        for batch, _, coded in encoded_batches(batches, encoder, "text"):
            counts, of_ids, of_bytes = [], [], []
            for held in coded:
                ids = memoryview(held).cast("i").tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(name.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(decode_bytes(ids, token)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
