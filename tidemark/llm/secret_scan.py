"""Secrets: fixed patterns plus a randomness battery, in Spark's own expressions only.

Base spans come from three patterns. Beside them every long run of credential
characters is tested: its encoding is inferred from the characters it uses, and its
symbols go through a chi-squared test of alphabet uniformity (as the index of
coincidence, which is the same statistic), a runs test and a lag-1 serial-correlation
test. A run is *reported* when

* the battery does not speak against uniform random symbols (``MIN_RANDOM_P``), and
* ordinary text would hardly look like it, after Benjamini-Hochberg control at ``FDR`` over
  all runs of the corpus, separately by length class (powers of two): short runs say little.

How hardly is measured by one statistic with the same three parts, the *evidence* in bits:
the run's likelihood under uniform symbols of its encoding over that under ordinary text,
where letters come by their frequencies (uniformity), and the kind of character, small
letter, capital, digit or sign, mostly stays as it was (runs and serial dependence). Under the
text model such a ratio is 2^b or more with probability 2^-b at most, whatever the length, so
2^-evidence is a p-value without a table or a floor. What the choice among the encodings
adds is taken off.

Runs of one or two different characters, decimal numbers, and runs that a base pattern
covers are no hypotheses of the family.

The control needs the evidence's histogram only: at most 129 bins by 32 classes reach
the driver, however large the corpus is.

Nulls: a null text counts as empty and has no spans. Empty texts have none. Very long
texts are scanned whole. Ties: overlapping spans of different kinds all stay; a run
that overlaps a base span is not reported again. Repeated rows get equal results. Empty tables
give empty results. Extra columns are carried through; one that has the name of a
result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import carried, restored


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: Fixed values of the patterns.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    "(" + "|".join(either_case(k) for k in KEYWORDS) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
MIN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: Matches whose places are summed in one step.
BLOCK = 128

#: Relative letter frequencies of ordinary text, in percent.
LETTERS = {
    "a": 8.2, "b": 1.5, "c": 2.8, "d": 4.3, "e": 12.7, "f": 2.2, "g": 2.0, "h": 6.1, "i": 7.0, "j": 0.2,
    "k": 0.8, "l": 4.0, "m": 2.4, "n": 6.7, "o": 7.5, "p": 1.9, "q": 0.1, "r": 6.0, "s": 6.3, "t": 9.1,
    "u": 2.8, "v": 1.0, "w": 2.4, "x": 0.2, "y": 2.0, "z": 0.1,
}

LOWER = "".join(LETTERS)
UPPER, DIGITS = LOWER.upper(), "0123456789"
#: Encodings, the narrowest first: pattern of all characters, alphabet.
ENCODINGS = {
    "hex": ("^[0-9a-f]+$", DIGITS + "abcdef"),
    "upper hex": ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    "lower": ("^[a-z]+$", LOWER),
    "upper": ("^[A-Z]+$", UPPER),
    "base32": ("^[A-Z2-7]+=*$", UPPER + "234567"),
    "base36": ("^[a-z0-9]+$", LOWER + DIGITS),
    "base62": ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": ("^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": ("", UPPER + LOWER + DIGITS + "-_+/="),
}
#: Share of false reports allowed among the reports of a length class.
FDR = 0.01
#: A run counts as random unless the battery's p-value is below this.
MIN_RANDOM_P = 0.001
#: Evidence in whole bits up to this: beyond it a run passes among any number of runs.
LAST_BIN = 128
#: Ordinary text: chance that the next character is of the kind given, by the kind before.
KIND_MOVES = {
    "lower": {"lower": 0.88, "upper": 0.05, "digit": 0.03, "sign": 0.04},
    "upper": {"lower": 0.45, "upper": 0.45, "digit": 0.05, "sign": 0.05},
    "digit": {"lower": 0.06, "upper": 0.06, "digit": 0.78, "sign": 0.10},
    "sign": {"lower": 0.40, "upper": 0.20, "digit": 0.20, "sign": 0.20},
}
#: The first character counts as if after a sign.
SIGNS = "+/_=-"


def kind_of(char: str) -> str | None:
    if char in SIGNS:
        return "sign"
    if not ("0" <= char <= "9" or "a" <= char.lower() <= "z"):
        return None
    return "digit" if char.isdigit() else "lower" if char.islower() else "upper"


def text_bits() -> dict[str, float]:
    """Bits that ordinary text takes for a character, by the character and the kind before it."""
    total = sum(LETTERS.values())
    out = {}
    for char in (c for c in map(chr, range(128)) if kind_of(c)):
        kind = kind_of(char)
        share = LETTERS[char.lower()] / total if kind in ("lower", "upper") else 1 / (10 if kind == "digit" else len(SIGNS))
        for before, moves in KIND_MOVES.items():
            out[before + char] = -math.log2(moves[kind] * share)
    return out


def bound(value: Column, body) -> Column:
    """``body`` of an array computed once, however often the body names it."""
    return F.flatten(F.transform(F.array(value), body))


def in_blocks(items: Column, after, body) -> Column:
    """``body(at, next, block)`` over blocks of an array; ``after(at, block)`` is where the next one begins.

    An array or text that grows item by item is copied each time; blocks keep it short.
    """

    def cut(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))

    def placed(blocks: Column) -> Column:
        one = lambda at, then, block: F.struct(at.alias("at"), then.alias("next"), block.alias("block"))
        none = F.slice(F.transform(blocks, lambda b: one(F.lit(0), F.lit(0), b)), 1, 0)

        def step(acc: Column, block: Column) -> Column:
            then = after(acc["at"], block)
            return F.struct(then.alias("at"), F.concat(acc["done"], F.array(one(acc["at"], then, block))).alias("done"))

        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), none.alias("done")), step, lambda acc: acc["done"])

    done = bound(bound(items, cut), placed)
    return F.when(F.size(items) > 0, F.transform(done, lambda b: body(b["at"], b["next"], b["block"])))


def find_spans(text: Column, pattern: str) -> Column:
    """Leftmost matches as array<struct<start, end, hit>>, in code points, end exclusive.

    The pieces between matches and the matches alternate, so running lengths give places.
    """
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(hits)),
        hits,
        lambda p, h: F.struct(F.length(p).alias("gap"), F.length(h).alias("size"), h.alias("hit")),
    )

    def after(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda n, p: n + p["gap"] + p["size"])

    def walked(at: Column, _: Column, block: Column) -> Column:
        def step(acc: Column, pair: Column) -> Column:
            start = acc["at"] + pair["gap"]
            end = start + pair["size"]
            one = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

        return F.aggregate(block, F.struct(at.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    found = bound(pairs, lambda ps: F.flatten(in_blocks(ps, after, walked)))
    return F.when(text.rlike(pattern), found).otherwise(none)


def with_kind(spans: Column, kind: str) -> Column:
    """Spans as sortable structs: start, rank of the kind, end."""
    rank = KINDS.index(kind)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))
    )


def chosen(column: Column, values: dict[str, float | str]) -> Column:
    """The value of an encoding."""
    out = F.lit(list(values.values())[-1])
    for name, value in list(values.items())[-2::-1]:
        out = F.when(column == name, F.lit(value)).otherwise(out)
    return out


def widen(df: DataFrame, **fields) -> DataFrame:
    """Each struct of ``runs`` with fields computed from it; a step of its own keeps analysis shallow."""

    def add(s: Column) -> Column:
        out = s
        for name, make in fields.items():
            out = out.withField(name, make(s))
        return out

    return df.withColumn("runs", F.transform("runs", add))


def normal_below(z: Column) -> Column:
    """P(Z <= z) of the standard normal, by a rational approximation (error below 1e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z < 0, half).otherwise(1 - half)


def tested_runs(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``runs``: long runs with encoding, the battery's p-value, evidence, length class and bin.

    Decimal numbers are no candidates: digits alone say nothing about being a secret. Nor are
    runs of one or two characters, or small hex numbers, which are base spans already.
    """
    enc = lambda s: F.coalesce(
        *[F.when(s["hit"].rlike(p), F.lit(name)) for name, (p, _) in ENCODINGS.items() if p], F.lit("base64url")
    )
    alphabets = {name: alphabet for name, (_, alphabet) in ENCODINGS.items()}
    bits = F.create_map(*[F.lit(x) for pair in text_bits().items() for x in pair])
    kind = lambda c: (
        F.when(c.rlike("[a-z]"), "lower").when(c.rlike("[A-Z]"), "upper").when(c.rlike("[0-9]"), "digit").otherwise("sign")
    )
    runs = F.filter(
        find_spans(F.col(text), RUN),
        lambda s: ~s["hit"].rlike("^[0-9a-f]+$") & (F.size(F.array_distinct(F.split(s["hit"], ""))) > 2),
    )
    df = widen(df.withColumn("runs", runs), enc=enc)
    df = widen(df, alphabet=lambda s: chosen(s["enc"], alphabets))
    df = widen(
        df,
        k=lambda s: F.length(s["alphabet"]).cast("double"),
        v=lambda s: F.filter(
            F.transform(F.split(s["hit"], ""), lambda c: F.instr(s["alphabet"], c)), lambda x: x > 0
        ),
    )
    # padding is no symbol: base32 and base64 alphabets have no "="
    df = widen(df, n=lambda s: F.size(s["v"]).cast("double"))
    df = df.withColumn("runs", F.filter("runs", lambda s: s["n"] >= 2))
    total = lambda xs, of: F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))
    df = widen(
        df,
        mean=lambda s: total(s["v"], lambda x: x.cast("double")) / s["n"],
        same=lambda s: total(
            F.transform(F.array_distinct(s["v"]), lambda d: F.size(F.filter(s["v"], lambda x: x == d)).cast("double")),
            lambda c: c * (c - 1) / 2,
        ),
        up=lambda s: F.size(F.filter(s["v"], lambda x: x > s["k"] / 2)).cast("double"),
        turns=lambda s: 1.0
        + F.size(
            F.filter(s["v"], lambda x, i: (i > 0) & ((x > s["k"] / 2) != (F.get(s["v"], i - 1) > s["k"] / 2)))
        ),
    )
    df = widen(
        df,
        spread=lambda s: total(s["v"], lambda x: (x - s["mean"]) * (x - s["mean"])),
        lagged=lambda s: total(
            F.transform(
                s["v"], lambda x, i: F.coalesce((x - s["mean"]) * (F.get(s["v"], i - 1) - s["mean"]), F.lit(0.0))
            ),
            lambda x: x,
        ),
        pairs=lambda s: s["n"] * (s["n"] - 1) / 2,
        mixed=lambda s: 2 * s["up"] * (s["n"] - s["up"]),
    )
    # z-values under uniform random symbols
    runs_var = lambda s: s["mixed"] * (s["mixed"] - s["n"]) / (s["n"] * s["n"] * (s["n"] - 1))
    df = widen(
        df,
        z_chi=lambda s: (s["same"] - s["pairs"] / s["k"]) / F.sqrt(s["pairs"] / s["k"] * (1 - 1 / s["k"])),
        z_runs=lambda s: F.when(
            runs_var(s) > 0, (s["turns"] - 1 - s["mixed"] / s["n"]) / F.sqrt(F.greatest(runs_var(s), F.lit(1e-9)))
        ).otherwise(F.lit(9.0)),
        z_serial=lambda s: F.when(
            s["spread"] > 0, (s["lagged"] / F.greatest(s["spread"], F.lit(1e-9)) + 1 / s["n"]) * F.sqrt(s["n"])
        ).otherwise(F.lit(9.0)),
        # symbols only, each behind its neighbour; the first as if after a sign
        chars=lambda s: F.filter(F.split(s["hit"], ""), lambda c: F.instr(s["alphabet"], c) > 0),
    )
    df = widen(df, kinds=lambda s: F.transform(s["chars"], kind))
    two_sided = lambda z: 2 * normal_below(-F.abs(z))
    df = widen(
        df,
        # three tests: Bonferroni
        p_random=lambda s: 3
        * F.least(normal_below(-s["z_chi"]), two_sided(s["z_runs"]), two_sided(s["z_serial"])),
        evidence=lambda s: total(
            F.transform(
                s["chars"],
                lambda c, i: F.element_at(bits, F.concat(F.when(i > 0, F.get(s["kinds"], i - 1)).otherwise("sign"), c)),
            ),
            lambda x: x,
        )
        - s["n"] * F.log2(s["k"])
        - math.log2(len(ENCODINGS)),
    )
    result = F.transform(
        "runs",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["enc"].alias("encoding"),
            s["p_random"].alias("p_random"),
            s["evidence"].alias("evidence"),
            F.floor(F.log2(s["n"])).cast("int").alias("length_class"),
            # rounded down: a bin counts as its least evidence, so control is kept
            F.least(F.lit(LAST_BIN), F.greatest(F.lit(0), F.floor(s["evidence"]))).cast("int").alias("bin"),
        ),
    )
    return df.withColumn("runs", result)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (sorted spans of the patterns) and ``runs`` (tested runs)."""
    body = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(
        find_spans(body, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= MIN_VALUE
    )
    base = F.sort_array(
        F.concat(
            with_kind(assign, "assign"),
            with_kind(find_spans(body, ACCESS), "access"),
            with_kind(find_spans(body, HEX), "hex"),
        )
    )
    return tested_runs(docs.withColumns({"base": base, "_body": body}), "_body").drop("_body")


def cutoffs(scanned: DataFrame) -> dict[int, int]:
    """Least bin that is reported, by length class: Benjamini-Hochberg on the histogram.

    A p-value is 2^-bin: evidence is rounded down, so control is kept.
    """
    runs = scanned.select(F.explode("runs").alias("r")).select("r.*")
    good = F.sum((F.col("p_random") >= MIN_RANDOM_P).cast("long"))
    rows = runs.groupBy("length_class", "bin").agg(F.count("*").alias("all"), good.alias("good")).collect()
    found: dict[int, int] = {}
    for cls in {r["length_class"] for r in rows}:
        own = sorted((r for r in rows if r["length_class"] == cls), key=lambda r: -r["bin"])
        m, seen = sum(r["all"] for r in own), 0
        for r in own:
            seen += r["good"]
            if seen and 2.0 ** -r["bin"] <= FDR * seen / m:
                found[cls] = r["bin"]
    return found


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: all spans, the reported runs among them."""
    scanned = scan(docs, text)
    least = cutoffs(scanned)

    def passes(r: Column) -> Column:
        ok = F.lit(False)
        for cls, bin_ in sorted(least.items()):
            ok = ok | ((r["length_class"] == cls) & (r["bin"] >= bin_))
        apart = ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
        return ok & (r["p_random"] >= MIN_RANDOM_P) & apart

    added = with_kind(F.filter("runs", passes), "random")
    return scanned.withColumn("spans", F.sort_array(F.concat("base", added))).drop("runs")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span (overlapping ones as one) replaced by ``mark``."""

    def after(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda n, s: F.greatest(n, s["end"]))

    def render(at: Column, then: Column, block: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            before = F.substring(acc["part"], acc["at"] - at + 1, s["start"] - acc["at"])
            out = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], before, F.lit(mark)))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"), acc["part"].alias("part"))

        part = F.substring(text, at + 1, then - at)
        zero = F.struct(at.alias("at"), F.lit("").alias("out"), part.alias("part"))
        return F.aggregate(block, zero, step, lambda acc: acc["out"])

    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(F.array_join(in_blocks(spans, after, render), ""), rest)
    )


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs``, their secrets replaced by a mark; same columns."""
    found = find_secrets(carried(docs))
    masked = F.when(F.col("text").isNotNull(), redacted(F.coalesce("text", F.lit("")), F.col("spans")))
    changed = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        before = F.col(f"carried_{docs.columns.index('n_chars')}")
        changed["n_chars"] = F.when(F.col("masked").isNotNull(), F.length("masked")).otherwise(before)
    return restored(found.withColumn("masked", masked), docs, **changed)
