"""BPE with word ends by a contiguous rank array per word, and its inverse.

A word is held as two short contiguous lists: its parts (token ids, one for each stretch
between two boundaries) and the rank of every adjacent pair. The least rank is looked for by
scanning, the leftmost one wins; its boundary is deleted from both lists and the ranks of
the two neighbours are looked up again. Words of over ``SHORT`` symbols, where scanning
again and again would take the square of the length, are merged with a heap over linked
parts instead, in the same order. Sequences of words are remembered within bounds.
Nothing is shuffled; only the vocabulary is sent to the tasks.

The vocabulary file is one of the ``tokenizers`` library: NFC, lower case, white space
between words dropped, special tokens found in the raw text. Decoding joins the tokens'
names with one space, as that library does for a file without decoder.

Nulls: a null text counts as empty; empty texts have no tokens. Very long texts are split
into words piece by piece, cut before a space that an ASCII letter or digit follows.
Repeated rows and ties get equal results; empty tables give empty results. Extra columns
are carried through; one that has the name of a result is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from tidemark.llm.common import id_lists, small_batches

#: Longer words are merged with a heap.
SHORT = 128
#: Texts longer than this are split into words piece by piece.
PIECE_CHARS = 1 << 20
#: Bytes of words and their sequences that a task remembers, with what Python adds.
REMEMBERED_BYTES = 80 << 20
#: What an entry takes besides its word and its ids.
ENTRY_BYTES = 190

NONE = 1 << 62


def byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in shown)
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def young_characters() -> tuple[str, str]:
    """The first character younger than Python's tables, and all of them as the inside of a class.

    What those tables don't say about them (letter or not, lower case, composition) the
    ``tokenizers`` library is asked, text by text.
    """
    spans: list[list[int]] = []
    assigned = regex.compile(r"\P{Cn}")
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn" and assigned.match(chr(c)):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    spans = spans or [[sys.maxunicode, sys.maxunicode]]
    return chr(spans[0][0]), "".join(f"{chr(a)}-{chr(b)}" for a, b in spans)


class Vocabulary:
    """Tokens, merges and special tokens of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        ids, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        names = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.width = max(names) + 1
        self.name = [names.get(i, "") for i in range(self.width)]
        self.inner = [ids[c] for c in byte_names()]
        self.last = [ids[c + self.end] for c in byte_names()]
        #: left id * width + right id to rank * width + merged id: the least value merges first
        self.pairs = {
            ids[a] * self.width + ids[b]: rank * self.width + ids[a + b] for rank, (a, b) in enumerate(model["merges"])
        }
        splitters = [p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = splitters[0]["pattern"]["Regex"]
        self.young = young_characters()


class Words(dict):
    """Word to the bytes of its int32 token ids; what is missing is encoded and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.size = vocabulary, 0

    def __missing__(self, word: str) -> bytes:
        found = array("i", self.merged(word.encode())).tobytes()
        self.size += ENTRY_BYTES + 2 * len(word) + len(found)
        self[word] = found
        return found

    def forget(self) -> None:
        """Back to nothing once the bound is reached; for between two texts."""
        if self.size > REMEMBERED_BYTES:
            self.clear()
            self.size = 0

    def merged(self, word: bytes) -> list[int]:
        v = self.vocabulary
        parts = [v.inner[b] for b in word[:-1]]
        parts.append(v.last[word[-1]])
        return scanned(parts, v.pairs, v.width) if len(parts) <= SHORT else heaped(parts, v.pairs, v.width)


def scanned(parts: list[int], pairs: dict[int, int], width: int) -> list[int]:
    """All merges of a short word; ``parts`` is used up."""
    rank = pairs.get
    ranks = [rank(a * width + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks:
        least = min(ranks)
        if least == NONE:
            break
        at = ranks.index(least)
        parts[at] = least % width
        del parts[at + 1], ranks[at]
        if at < len(ranks):
            ranks[at] = rank(parts[at] * width + parts[at + 1], NONE)
        if at:
            ranks[at - 1] = rank(parts[at - 1] * width + parts[at], NONE)
    return parts


def heaped(parts: list[int], pairs: dict[int, int], width: int) -> list[int]:
    """All merges of a long word, in the order of ``scanned``."""
    n = len(parts)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [
        (found, i, parts[i], parts[i + 1])
        for i in range(n - 1)
        if (found := pairs.get(parts[i] * width + parts[i + 1])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        found, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j < 0 or parts[j] != right:
            continue  # merged otherwise since
        parts[i], parts[j], after[i] = found % width, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (new := pairs.get(parts[a] * width + parts[b])) is not None:
                heapq.heappush(heap, (new, a, parts[a], parts[b]))
    return [p for p in parts if p >= 0]


class Encoder:
    """Token ids of texts, as bytes of int32."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = Words(vocabulary)
        self.split = regex.compile(vocabulary.pattern)
        first, young = vocabulary.young
        self.high, self.young = re.compile(f"[{first}-{chr(sys.maxunicode)}]"), re.compile(f"[{young}]")
        self.library_norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.library_split = pre_tokenizers.Split(Regex(vocabulary.pattern), "removed", invert=True)
        self.special = {t: array("i", [i]).tobytes() for t, i in vocabulary.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.cut = regex.compile(r"(?<=\S) (?=[0-9A-Za-z])")

    def pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PIECE_CHARS and (cut := self.cut.search(text, start + PIECE_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def split_words(self, text: str) -> list[str]:
        if not text.isascii() and self.high.search(text) and self.young.search(text):
            return [w for w, _ in self.library_split.pre_tokenize_str(self.library_norm.normalize_str(text))]
        # lower case goes by character: no capital sigma takes its form at a word's end
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        out = []
        for piece in self.pieces(text):
            out.append(b"".join(map(self.words.__getitem__, self.split_words(piece))))
            self.words.forget()
        return out[0] if len(out) == 1 else b"".join(out)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.marks is None or not self.marks.search(text):
            return self.plain(text)
        return b"".join(self.special.get(x) or self.plain(x) for x in self.marks.split(text) if x)


def decoded(ids, name: list[str]) -> str:
    return " ".join(map(name.__getitem__, ids))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens``, the ids of each text."""
    small_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    docs = docs.drop("tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            yield batch.append_column("tokens", id_lists([encoder(t) for t in batch.column(text).to_pylist()]))

    return docs.mapInArrow(run, docs.withColumn("tokens", F.array().cast("array<int>")).schema)


def decode(encoded: DataFrame, path: str, tokens: str = "tokens") -> DataFrame:
    """``encoded`` with ``decoded``: the tokens' names with spaces between; null where the ids are null."""
    small_batches(encoded.sparkSession)
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path))
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = vocabulary.value.name
        for batch in batches:
            ids = batch.column(tokens).to_pylist()
            yield batch.append_column(
                "decoded", pa.array([None if x is None else decoded(x, name) for x in ids], pa.string())
            )

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit("")).schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them, in one pass."""
    small_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, name = Encoder(vocabulary.value), vocabulary.value.name
        number = [str(i) for i in range(len(name))]
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text"):
                ids = memoryview(encoder(text.as_py())).cast("i").tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(decoded(ids, number).encode()).hexdigest())
                of_text.append(hashlib.sha256(decoded(ids, name).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
