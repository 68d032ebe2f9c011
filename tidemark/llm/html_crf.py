"""Main-text extraction: a linear-chain conditional random field over a page's leaf blocks.

A page is cut at block-level tags into leaf blocks. A block's features are its tag, its
ancestors' tags, the words of their class, id and role, and properties of its text (length,
share of link text, ending, marks, place in the page). The field has two labels (text,
other) with start and transition weights. It is fitted by penalised likelihood (forward and
backward sums, Adam steps) on at most ``TRAINING_PAGES`` pages, the first by hash of
their url: pages whose markup names the article are labelled by it. Each also counts with
that markup taken away, so that text features carry pages without it. The penalty pulls
weights to ``PRIOR`` instead of zero, which is what an unlabelled corpus gets.
Pages are decoded by Viterbi, each on its own.

Nulls: null or empty html, and pages without text, give an empty text. Very long pages
are taken whole, in time that grows with their length, whatever their markup. Broken
markup: unknown and unmatched tags are passed over, an unclosed comment or script ends with
the page; an element that is left out, such as a button, but isn't closed counts for nothing. Repeated rows and ties (text wins) get equal
results; empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

TRAINING_PAGES = 300
STEPS, RATE, PENALTY = 120, 0.1, 0.02

#: Tags that start and end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is no markup; without an end tag it goes on to the end of the page.
RAW_TAGS = frozenset("script style textarea title".split())
#: Elements whose text isn't the page's; without an end tag further on they count for nothing.
LEFT_OUT = frozenset("noscript template svg iframe object button select".split())
#: Of these, such as can't hold blocks: a block that opens ends them.
NO_BLOCKS = frozenset("svg iframe button select".split())
#: An opening tag ends open elements of these kinds.
ENDED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
#: Words of class, id or role that name other than the article.
OTHER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments consent cookie cookies footer header login "
    "masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted related reply "
    "respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
OTHER_TAGS = frozenset("nav aside footer form menu dialog".split())
#: Weights the penalty pulls to, in favour of text.
PRIOR = {
    **{f"in:{t}": -6.0 for t in OTHER_TAGS},
    **{f"word:{w}": -6.0 for w in OTHER_WORDS},
    "in:header": -1.5, "in:article": 3.0, "in:main": 2.0, "tag:p": 1.0, "tag:li": -0.5, "tag:head": -4.0,
    "stop": 0.5, "links:all": -2.0, "links:most": -1.0, "sign": -2.0, "tag:h1": 1.0, "word:article": 2.0,
    "word:content": 1.0, "word:main": 1.5,
}

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile("[<>\"']")
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Stack:
    """Open elements; each knows the tags and words of itself and all above it."""

    def __init__(self):
        self.held: list[tuple[str, frozenset, frozenset]] = []
        self.count: Counter[str] = Counter()
        self.hidden = 0  # how many of them are left out

    def top(self) -> str:
        return self.held[-1][0] if self.held else ""

    def push(self, tag: str, words: frozenset = frozenset()) -> None:
        tags, known = self.held[-1][1:] if self.held else (frozenset(), frozenset())
        # equal sets are shared, however deep the page
        self.held.append((tag, tags if tag in tags else tags | {tag}, known if words <= known else known | words))
        self.count[tag] += 1
        self.hidden += tag in LEFT_OUT

    def pop(self) -> str:
        tag = self.held.pop()[0]
        self.count[tag] -= 1
        self.hidden -= tag in LEFT_OUT
        return tag

    def close(self, tag: str) -> None:
        """End the innermost element of a kind, if there is one."""
        if self.count[tag]:
            while self.pop() != tag:
                pass


class Block:
    __slots__ = ("link_chars", "parents", "tag", "text", "words")

    def __init__(self, text: str, link_chars: int, stack: Stack):
        self.text, self.link_chars = text, link_chars
        self.tag = stack.top() or "body"
        self.parents, self.words = stack.held[-1][1:] if stack.held else (frozenset(), frozenset())


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, closing, attributes) of every tag; comments and declarations have no tag.

    One pass: a tag ends at ``>`` outside quotes, or before the next ``<``. If quotes hide
    every later ``>``, the tag ends at the first one, and quotes mean nothing from there on.
    """
    at, quotes, last = 0, True, page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, "", False, ""
            continue
        if start > last:
            return
        if page[start + 1 : start + 2] in ("!", "?"):
            at = page.find(">", start) + 1
            yield start, at, "", False, ""
            continue
        name = _NAME.match(page, start)
        if not name:
            at = start + 1
            continue
        end = at = name.end()
        while True:
            stop = _STOP.search(page, at)
            if not stop:
                # all that follows is quoted
                at, quotes = page.find(">", end) + 1, False
                break
            at = stop.start()
            if stop[0] == ">":
                at += 1
                break
            if stop[0] == "<":
                break
            closed = page.find(stop[0], at + 1) if quotes else -1
            at = closed + 1 if closed >= 0 else at + 1
        yield start, at, name[1].lower(), page[start + 1] == "/", page[end:at].rstrip(">")


def leaf_blocks(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    stack = Stack()
    parts: list[str] = []
    links = [0, 0]  # depth, characters

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(Block(text, links[1], stack))
        parts.clear()
        links[1] = 0

    lowered: str | None = None
    ends: dict[str, int] = {}

    def last_end(tag: str) -> int:
        """Where the last end tag of a kind stands; looked up once."""
        nonlocal lowered
        if tag not in ends:
            lowered = page.lower() if lowered is None else lowered
            ends[tag] = lowered.rfind(f"</{tag}")
        return ends[tag]

    at = raw_end = 0
    for start, end, tag, closing, told in tokens(page):
        if start < raw_end:
            continue
        if start > at and not stack.hidden:
            parts.append(page[at:start])
            if links[0]:
                links[1] += start - at
        at = end
        if not tag:
            continue
        if tag in RAW_TAGS and not closing:
            found = _RAW_END[tag].search(page, at)
            at = raw_end = found.end() if found else len(page)
            if tag != "title":
                parts.append(" ")
            continue
        if tag in LEFT_OUT:
            parts.append(" ")
            if closing:
                stack.close(tag)
            elif not told.endswith("/") and last_end(tag) > at:
                stack.push(tag)
            continue
        if tag == "a":
            links[0] = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        if not (stack.hidden and tag == "option"):
            flush()
        links[0] = 0
        if closing:
            stack.close(tag)
            continue
        if tag in VOID_TAGS:
            continue
        while tag != "option" and stack.top() in NO_BLOCKS:
            stack.pop()
        if stack.top() == "p":
            stack.pop()
        ended = ENDED_BY.get(tag, ())
        while stack.top() in ended:
            stack.pop()
        named = " ".join("".join(m.groups("")) for m in _NAMED.finditer(told)) if told else ""
        stack.push(tag, frozenset(w.lower() for w in _WORDS.findall(named)))
    if at < len(page) and not stack.hidden:
        parts.append(page[at:])
    flush()
    return out


_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW_TAGS}


def features(blocks: list[Block], hide: frozenset = frozenset()) -> list[list[str]]:
    """Names of each block's features; ``hide`` are tags and words to leave out."""
    out = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        size = len(b.text.split(" "))
        share = b.link_chars / len(b.text)
        names = [f"in:{t}" for t in b.parents if t not in hide]
        names += [f"word:{w}" for w in b.words if w not in hide]
        names.append(f"tag:{b.tag if b.tag not in hide else 'div'}")
        names.append(f"size:{min(8, int(math.log2(size)))}")
        names.append("links:all" if share > 0.8 else "links:most" if share > 0.4 else "links:few")
        last = b.text.rstrip("\"'”’»)")[-1:]
        names.append("stop" if last in ".!?…:" else "open")
        if "©" in b.text or "|" in b.text:
            names.append("sign")
        if "," in b.text:
            names.append("comma")
        names.append("first" if i == 0 else "last" if i == n - 1 else "inner")
        names.append("bias")
        out.append(names)
    return out


def labels_of(blocks: list[Block]) -> list[int] | None:
    """1 for blocks of the marked article; None when the markup doesn't mark one."""
    marked = [
        bool(b.parents & {"article", "main"} or "articlebody" in b.words)
        and not b.parents & OTHER_TAGS
        and not b.words & OTHER_WORDS
        for b in blocks
    ]
    return [int(m) for m in marked] if any(marked) else None


HIDDEN = frozenset({"article", "main", "body", "articlebody"})


class Field:
    """Weights of the field: by feature name, start (2) and transitions (2 x 2), for label 1 against 0."""

    def __init__(self, weights: dict[str, float], start: list[float], moves: list[list[float]]):
        self.weights, self.start, self.moves = weights, start, moves

    def decode(self, names: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        get = self.weights.get
        back: list[tuple[int, int]] = []
        a, b = 0.0, 0.0
        (m00, m01), (m10, m11) = self.moves
        for i, own in enumerate(names):
            gain = sum([get(f, 0.0) for f in own])
            if i == 0:
                a, b = self.start[0], self.start[1] + gain
                continue
            from0, from1 = a + m01, b + m11
            stay0, stay1 = a + m00, b + m10
            back.append((int(stay1 >= stay0), int(from1 >= from0)))
            a, b = max(stay0, stay1), max(from0, from1) + gain
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Penalised maximum likelihood; pages are padded and summed over together."""
    prior = dict(PRIOR)
    names = sorted({f for seq, _ in pages for own in seq for f in own} | set(prior))
    number = {f: i for i, f in enumerate(names)}
    w0 = np.array([prior.get(f, 0.0) for f in names])
    move0 = np.array([[0.5, -0.5], [-0.5, 0.5]])
    if not pages:
        return Field(dict(zip(names, w0.tolist(), strict=True)), [0.0, 0.0], move0.tolist())
    longest = max(len(seq) for seq, _ in pages)
    at: list[int] = []
    used: list[int] = []
    y = np.full((len(pages), longest), -1)
    for p, (seq, labels) in enumerate(pages):
        y[p, : len(labels)] = labels
        for t, own in enumerate(seq):
            at += [p * longest + t] * len(own)
            used += [number[f] for f in own]
    rows, cols = np.array(at), np.array(used)
    real = y >= 0
    w, start, moves = w0.copy(), np.zeros(2), move0.copy()
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, start, moves)]
    n = len(pages)
    for step in range(1, STEPS + 1):
        gain = np.bincount(rows, w[cols], n * longest).reshape(n, longest)
        score = np.stack([np.zeros_like(gain), gain], axis=2)
        ahead = np.empty((n, longest, 2))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + score[:, t]
            ahead[:, t] = np.where(real[:, t : t + 1], nxt, ahead[:, t - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            reach = behind[:, t + 1] + score[:, t + 1]
            prev = np.logaddexp(moves[:, 0] + reach[:, :1], moves[:, 1] + reach[:, 1:])
            behind[:, t] = np.where(real[:, t + 1 : t + 2], prev, 0.0)
        p1 = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * real
        off = (real & (y == 1)) - p1
        g_w = np.bincount(cols, off.ravel()[rows], len(w)) / n - PENALTY * (w - w0)
        first = np.array([np.sum(y[:, 0] == k) for k in (0, 1)]) - np.array([n - p1[:, 0].sum(), p1[:, 0].sum()])
        g_moves = np.zeros((2, 2))
        both = real[:, 1:]
        for i in (0, 1):
            for j in (0, 1):
                seen = np.sum((y[:, :-1] == i) & (y[:, 1:] == j) & both)
                mass = np.exp(
                    ahead[:, :-1, i] + moves[i, j] + score[:, 1:, j] + behind[:, 1:, j] - total[:, None]
                )
                g_moves[i, j] = seen - np.sum(mass[both])
        grads = (g_w, first / n - PENALTY * start, g_moves / n - PENALTY * (moves - move0))
        for x, g, (m1, m2) in zip((w, start, moves), grads, state, strict=True):
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.999
            m2 += 0.001 * g * g
            x += RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Field(dict(zip(names, w.tolist(), strict=True)), start.tolist(), moves.tolist())


def train(pages: DataFrame) -> Field:
    """The field of a bounded sample: the first pages by hash of page_id and url."""
    held = pages.filter("html is not null").select(
        F.xxhash64("page_id", "url").alias("_order"), F.col("html").cast("string").alias("html")
    )
    # the hashes first, then the pages they name: no task sends more than its share of these
    first = [r[0] for r in held.select("_order").distinct().orderBy("_order").limit(TRAINING_PAGES).collect()]
    chosen = held.filter(F.col("_order").isin(first)) if first else held.limit(0)
    rows = chosen.groupBy("_order").agg(F.min("html").alias("html")).orderBy("_order").collect()
    labelled = []
    for row in rows:
        blocks = leaf_blocks(row["html"])
        labels = labels_of(blocks)
        if labels:
            labelled += [(features(blocks), labels), (features(blocks, HIDDEN), labels)]
    return fit(labelled)


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page) if page else []
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, label in zip(blocks, field.decode(features(blocks)), strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession)
    field = field or train(pages)
    weights = (field.weights, field.start, field.moves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*weights)
        for batch in batches:
            texts = [main_text(page, own) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    chosen = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
