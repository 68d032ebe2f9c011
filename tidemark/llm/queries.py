"""The registered queries of the operators, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bloom_lm,
    bpe,
    cgk,
    chat,
    gam,
    html_crf,
    minhash,
    prefix_trie,
    quality_rules,
    repair,
    secret_scan,
    token_counts,
    word_bpe,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    """Register the decorated function under its name, with its SQL if it has one."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quality_sql(source: str = "documents") -> str:
    """The rules in DuckDB SQL: every document of ``source`` with its counts and verdict."""
    q = quality_rules
    re = text_literal
    phrases = " OR ".join(f"contains(lowered, {re(p)})" for p in q.BOILERPLATE)
    lowered = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = phrases.replace("lowered", lowered)
    return rf"""
    WITH body AS (SELECT doc_id, coalesce(text, '') AS body FROM {source}),
    parts AS (
      SELECT doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, {re(q.HAS_WORD)})) AS lines FROM body),
    judged AS (
      SELECT *, list_filter(lines, lambda l:
          (regexp_matches(l, {re(q.TERMINAL)})
           OR (regexp_matches(l, {re(q.INNER_MARK)}) AND regexp_matches(l, {re(q.INNER_END)})))
          AND NOT (regexp_matches(l, {re(f"{q.NAVIGATION}|{q.SYMBOL_RUN}|{q.EXCLAIMED}")}))
          AND NOT (NOT regexp_matches(l, {re(q.LOWER)}) AND regexp_matches(l, {re(q.CAPITALS)}))
          AND NOT ({phrases})) AS good FROM parts),
    grams AS (
      SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
    repeated AS (
      SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams)
      WHERE c > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + j) AS n FROM repeated, (VALUES (0), (1), (2)) AS s(j) GROUP BY doc_id),
    counted AS (
      SELECT judged.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(coalesce(array_to_string(words, ''), '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(body, {re(q.SYMBOLS)})) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(lines) AS BIGINT) AS n_lines,
             length(coalesce(array_to_string(lines, ''), '')) AS line_chars,
             CAST(length(coalesce(array_to_string(lines, ''), ''))
                  - length(coalesce(array_to_string(good, ''), '')) AS BIGINT) AS lost_chars,
             coalesce(array_to_string(good, chr(10)), '') AS cleaned
      FROM judged LEFT JOIN covered USING (doc_id)),
    based AS (
      SELECT *, (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words) AS base_failed
      FROM counted)
    SELECT *, (NOT base_failed AND 100 * lost_chars <= {q.MAX_LOST_PCT} * line_chars) AS kept FROM based"""


@query(
    f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines,
               lost_chars FROM ({quality_sql()})"""
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every document: counts, lost characters, verdict."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "lost_chars",
    )


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans by pattern, further ones by randomness tests."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(
        F.filter("base", lambda s: s["rank"] == secret_scan.KINDS.index(kind))
    ).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.spans_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by merge replay and decoded again, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@query()
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, by links confirmed on full shingle sets."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents: one row per document and item, the best stretch."""
    found = cgk.with_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query()
def op7_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of all documents from a log-frequency Bloom filter, beside exact unigram scores."""
    return bloom_lm.score(table(spark, sf_dir, "documents"))


@query()
def op8_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a conditional random field over its leaf blocks."""
    return html_crf.extract(table(spark, sf_dir, "pages"))


@query()
def op6_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the additive model of the labelled ones."""
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, the text encoded whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, RANKS, public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_tokens", F.explode("counts").alias("line")).select(
        "doc_id",
        "n_tokens",
        F.col("line.name").cast("int").alias("line"),
        F.col("line.start").alias("first_char"),
        F.col("line.end").alias("end_char"),
        F.col("line.n").alias("n_line_tokens"),
        F.col("line.crossing").alias("n_crossing"),
    )


CHAT_SQL = f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '{chat.UNKNOWN}') AS role, coalesce(text, '') AS body
      FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (
      SELECT *, coalesce(sum(length(role) + length(body) + {len(chat.BEGIN) + len(chat.END) + 1}) OVER (
                  PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM t),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{chat.SYSTEM}'),
    views AS (
      SELECT conv_id, speaker, CAST(place // {chat.PART_CHARS} AS INTEGER) AS part, place, role = speaker AS own,
             '{chat.BEGIN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{chat.SYSTEM}' THEN role
                                    ELSE 'user name=' || role END || chr(10) AS head,
             body || '{chat.END.strip()}' || chr(10) AS body
      FROM placed JOIN speakers USING (conv_id)),
    spans AS (
      SELECT *, coalesce(sum(length(head) + length(body)) OVER (
                  PARTITION BY conv_id, speaker, part ORDER BY place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS first FROM views)
    SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS text,
           coalesce(string_agg(CAST(first AS BIGINT) || ':' || CAST(first + length(body) AS BIGINT), ',' ORDER BY place)
                      FILTER (WHERE own), '') AS masks
    FROM spans GROUP BY conv_id, speaker, part"""


@query(CHAT_SQL)
def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from every participant's perspective, with the spans to learn from."""
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return chat.rotate(table(spark, sf_dir, "conversations")).withColumn("masks", F.array_join(spans, ","))


@query()
def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by rank arrays over its words and decoded again, as digests."""
    return word_bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, the cheapest edits, a digest of the repaired lines."""
    damaged = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair(damaged)


#: Unsigned crc32 of the decimal conv_id: each byte and seven zeros, shifted in bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda r, x: xor(xor(r, x) >> 1, 3988292384::BIGINT * (xor(r, x) & 1))), 4294967295::BIGINT)"""

TRIE_SQL = f"""
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT conv_id, {CRC32_SQL} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
    rebuilt AS (
      SELECT ids.conv_id, i, role, body FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 100 AND i <= h
      UNION ALL
      SELECT ids.conv_id, i, role, body FROM ids JOIN t ON t.conv_id = ids.conv_id AND i > h),
    placed AS (
      SELECT conv_id, length(body) AS chars, row_number() OVER w AS depth,
             string_agg(md5(length(role) || ':' || role || body), '') OVER w AS path
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    members AS (
      SELECT conv_id, depth, chars, md5(path) AS node, coalesce(lag(md5(path)) OVER v, 'root') AS above,
             lead(depth) OVER v IS NULL AS is_end
      FROM placed WINDOW v AS (PARTITION BY conv_id ORDER BY depth)
      UNION ALL
      SELECT conv_id, 0, 0, 'root', NULL, conv_id NOT IN (SELECT conv_id FROM placed) FROM ids),
    nodes AS (
      SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * max(chars) AS saved,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
      FROM members GROUP BY node, depth),
    children AS (SELECT above, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
    counted AS (
      SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.above = nodes.node),
    below AS (
      SELECT m.node, sum(c.saved) AS saved, sum(CAST(c.n_children = 0 AS BIGINT)) AS n_leaves
      FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.depth <= c.depth GROUP BY m.node)
    SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
           CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, c.ends_sha256
    FROM counted c JOIN below b ON b.node = c.node LEFT JOIN counted p ON p.node = c.above"""


@query(TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
