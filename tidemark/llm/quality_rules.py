"""Line-first quality rules, made of Spark's own expressions only.

Every line is judged alone (terminal punctuation, navigation, boilerplate, symbols,
shouting), failing lines are removed, and a document that loses too much of its text
is rejected. Document-level counts (words, repeats) are computed beside it.

Nulls: a null text counts as empty; an empty text has no words and is rejected by the
length rule. Ties and repeated rows: each row is judged by itself, so equal rows get
equal results. Empty tables give empty results. Extra columns are carried through and
never read; a column that already has the name of a result is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import carried, restored, words

#: Fixed values of the rules.
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
# a sentence mark, maybe inside closing quotes or brackets, at the end of the line
TERMINAL = r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*\z"
# or a sentence that ends inside a line of at least 12 words
INNER_END = r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){11}"
INNER_MARK = r"[.!?][\"'”’»)\]]*[\x20\x09-\x0D]"
NAVIGATION = r"\|[^\n]*\||[»›→•·][^\n]*[»›→•·]"
BOILERPLATE = (
    "javascript",
    "cookie",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "all rights reserved",
    "lorem ipsum",
    "subscribe to our",
    "click here",
    "read more",
    "skip to content",
    "licensed under",
    "add to cart",
)
# no line without one of these can fail by navigation, symbols or exclamation
SUSPECT = r"[|»›→•·#*$%&<>!]"
SYMBOL_RUN = r"([#*$%&|<>]{2}[^\n]*){3}"
EXCLAIMED = r"!![^\n]*!!"
LOWER = r"\p{Ll}"
CAPITALS = r"(\p{Lu}[^\n]*){4}"

#: Documents with fewer words are rejected.
MIN_WORDS = 50
#: Percentage of words in repeated 3-word windows beyond which a document is rejected.
MAX_REPEAT_PCT = 50
#: A document is rejected when its removed lines hold more than this share of its line text.
MAX_LOST_PCT = 50


def has_boilerplate(text: Column) -> Column:
    """True for a text with a boilerplate phrase anywhere: a cheap test before the lines'."""
    return reduce(or_, [F.contains(text, F.lit(phrase)) for phrase in BOILERPLATE])


def good_line(line: Column) -> Column:
    """True for a line of prose, boilerplate phrases aside."""
    shouted = ~line.rlike(LOWER) & line.rlike(CAPITALS)
    bad = line.rlike(SUSPECT) & line.rlike(f"{NAVIGATION}|{SYMBOL_RUN}|{EXCLAIMED}")
    ends = line.rlike(TERMINAL) | (line.rlike(INNER_MARK) & line.rlike(INNER_END))
    return ends & ~bad & ~shouted


def repeat_words(df: DataFrame, words_col: str, out: str) -> DataFrame:
    """Words of ``words_col`` that lie in 3-word windows found twice or more in it.

    Windows are 64-bit hashes. Only where some hash repeats are (hash, place) pairs
    sorted; equal neighbours mark places, and the marked windows' union is counted, so
    the cost is n log n however long the text is.
    """
    n = F.size(words_col)
    at = lambda i: F.element_at(words_col, (i + 1).cast("int"))
    grams = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_grams", grams)
    pairs = F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn(
        "_pairs", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), pairs).otherwise(none)
    )
    same = lambda i, j: F.coalesce(F.get("_pairs", i)["h"] == F.get("_pairs", j)["h"], F.lit(False))
    marked = F.filter("_pairs", lambda p, i: same(i, i - 1) | same(i, i + 1))
    df = df.withColumn("_marked", F.sort_array(F.transform(marked, lambda p: p["i"])))
    steps = F.transform("_marked", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_marked", i + 1) - p, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0), lambda a, b: a + b)
    return df.withColumn(out, covered.cast("long")).drop("_grams", "_pairs", "_marked")


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``lost_pct``, ``cleaned`` and ``kept``."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_words", words(F.col(text)))
    df = df.withColumn("_lines", F.filter(F.split(body, "\n"), lambda line: line.rlike(HAS_WORD)))
    df = repeat_words(df, "_words", "n_repeat_words")
    df = df.withColumn("_good", F.filter("_lines", good_line))
    phrases = "(?i)" + "|".join(BOILERPLATE)
    # the phrases are looked for line by line only where the whole text has one
    df = df.withColumn(
        "_good",
        F.when(
            has_boilerplate(F.lower(body)), F.filter("_good", lambda line: ~line.rlike(phrases))
        ).otherwise(F.col("_good")),
    )
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_all": F.length(F.array_join("_lines", "")).cast("long"),
            "_left": F.length(F.array_join("_good", "")).cast("long"),
            "cleaned": F.array_join("_good", "\n"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    lost = F.col("_all") - F.col("_left")
    df = df.withColumns({"base_failed": failed, "n_lines": F.size("_lines").cast("long"), "lost_chars": lost})
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PCT * F.col("_all"))
    return df.withColumn("kept", kept).drop("_words", "_lines", "_good", "_all", "_left")


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that pass, their text without the failing lines, same columns."""
    # a filter moves below the projections with all they compute written out, once per use;
    # beside a row number it stays above them
    kept = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    judged = judge(carried(docs)).withColumn("kept", kept).filter("kept")
    return restored(judged, docs, text=F.col("cleaned"), n_chars=F.length("cleaned"))

