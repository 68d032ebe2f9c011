"""Token counts by section: whole texts are encoded once, offsets decide whose a token is.

A text is encoded whole, so that tokens are those a model would see. Every token's
character span is joined with the sections' spans (an interval join by binary search in
the sorted spans; both lists belong to one row). A token that crosses a boundary goes by
an explicit rule:

* ``start``: to the section that holds its first character;
* ``middle``: to the section that holds its middle (a middle on a boundary: the later one);
* ``share``: to every section it meets, in proportion to its characters there.

Where a character's bytes are split between tokens, each of them begins at that character;
for ``share`` the character belongs to the one that holds its first byte, and a token that
holds no first byte counts whole where the character of its bytes is.

Sections are spans of the text: lines, or fields that were joined to one text. They may
overlap or leave gaps; each is counted on its own.

Nulls: a null text counts as empty. An empty text has one empty line; a row without
sections gives no rows. Very long texts are encoded whole. Repeated rows and ties get
equal results; empty tables give empty results. Extra columns are carried through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

RULES = ("start", "middle", "share")
SECTION = "array<struct<name:string,start:int,end:int>>"


def field_sections(fields: dict[str, Column], separator: str = "\n\n") -> tuple[Column, Column]:
    """The text that joins ``fields``, and a section per field; null fields count as empty."""
    parts = [F.coalesce(c, F.lit("")) for c in fields.values()]
    text = F.concat_ws(separator, *parts)
    start: Column = F.lit(0)
    sections = []
    for name, part in zip(fields, parts, strict=True):
        end = start + F.length(part)
        sections.append(F.struct(F.lit(name).alias("name"), start.alias("start"), end.alias("end")))
        start = end + len(separator)
    return text, F.array(*sections).cast(SECTION)


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of a text, in characters."""
    sizes = [len(line) + 1 for line in text.split("\n")]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    ends[-1] -= 1
    return starts, ends


def token_spans(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens, in characters: those that a token's bytes belong to."""
    if not len(sizes):
        return np.empty(0, int), np.empty(0, int)
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    begun = np.concatenate([[0], np.cumsum(begins)])
    last = np.cumsum(sizes)
    first = last - sizes
    return begun[first] - ~begins[first], begun[last]


def attribute(
    starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str
) -> np.ndarray:
    """Tokens (or shares of tokens) of every section [first, last)."""
    if rule == "share":
        # tokens that end by a place, and of the one around it the part before
        places = np.concatenate([[0], ends, [np.inf]])

        def at(x: np.ndarray) -> np.ndarray:
            done = np.searchsorted(ends, x, "right")
            return done + (x - places[done]) / (places[done + 1] - places[done])

        return np.where(last > first, at(last) - at(first), 0.0)
    point = 2 * starts if rule == "start" else starts + ends
    inside = np.searchsorted(point, 2 * last, "left") - np.searchsorted(point, 2 * first, "left")
    return np.where(last > first, inside, 0)


def crossing(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tokens that begin in a section and end beyond it."""
    begun = np.searchsorted(starts, last, "left")
    done = np.maximum(np.searchsorted(ends, last, "right"), np.searchsorted(starts, first, "left"))
    return np.where(last > first, np.maximum(begun - done, 0), 0)


class Sizes:
    """Bytes of each token, and the encoder, from a rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encoding = tiktoken.Encoding("sizes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        return token_spans(text.encode(), self.size[ids])


def load(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def count_tokens(
    docs: DataFrame, path: str, pattern: str, text: str = "text", sections: str | None = None, rule: str = "start"
) -> DataFrame:
    """``docs`` without text, with ``n_tokens`` of the whole text and ``counts`` of its sections.

    ``counts``: array of (name, start, end, n, crossing); ``n`` by ``rule``, ``crossing``: tokens
    that begin in the section and end beyond it. ``sections`` names a column of spans; without
    it the text's lines are counted.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    small_batches(docs.sparkSession)
    # as large as the vocabulary, whatever the corpus holds
    ranks = docs.sparkSession.sparkContext.broadcast(load(path))
    number = "double" if rule == "share" else "bigint"
    kind = f"array<struct<name:string,start:int,end:int,n:{number},crossing:bigint>>"
    rest = [c for c in docs.columns if c not in (text, sections, "n_tokens", "counts")]
    chosen = docs.select(
        *rest,
        F.col(text).cast("string").alias("_text"),
        *([F.col(sections).cast(SECTION).alias("_sections")] if sections else []),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(ranks.value, pattern)
        for batch in batches:
            totals, offsets, names, firsts, lasts, counts, crossings = [], [0], [], [], [], [], []
            spans = batch.column("_sections").to_pylist() if sections else None
            for i, body in enumerate(batch.column("_text").to_pylist()):
                body = body or ""
                starts, ends = sizes.spans(body)
                if spans is None:
                    first, last = line_bounds(body)
                    names += map(str, range(len(first)))
                else:
                    own = [s for s in spans[i] or [] if s and s["start"] is not None and s["end"] is not None]
                    first, last = (np.array([s[c] for s in own], int) for c in ("start", "end"))
                    names += [s["name"] for s in own]
                totals.append(len(ends))
                firsts.append(first)
                lasts.append(last)
                counts.append(attribute(starts, ends, first, last, rule))
                crossings.append(crossing(starts, ends, first, last))
                offsets.append(offsets[-1] + len(first))
            join = lambda parts, kind: pa.array(np.concatenate(parts), kind)
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(names, pa.string()),
                    join(firsts, pa.int32()),
                    join(lasts, pa.int32()),
                    join(counts, pa.float64() if rule == "share" else pa.int64()),
                    join(crossings, pa.int64()),
                ],
                ["name", "start", "end", "n", "crossing"],
            )
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(totals, pa.int64()), listed], [*rest, "n_tokens", "counts"]
            )

    out = chosen.select(*rest, F.lit(0).cast("long").alias("n_tokens"), F.array().cast(kind).alias("counts"))
    return chosen.mapInArrow(run, out.schema)
