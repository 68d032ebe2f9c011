"""Multi-party perspective rotation, made of Spark's own expressions only.

For every participant of a dialogue the whole dialogue is rendered with that speaker as
the assistant, the others as named users and system turns as such. Masks are the
character spans to learn from: what the assistant says, with the end mark.

Long dialogues come in parts of about ``part_chars`` characters, cut between turns, so that
no group that Spark gathers is larger; short ones have the one part 0. Parts put end to end
are the whole rendering: a system turn stands in the part where it was said and isn't
repeated. With ``part_chars=None`` every dialogue is one row, however long. Where a turn stands
in its dialogue is a running sum over range partitions (a dialogue that holds most rows
is spread over many) plus the sums of the partitions before, a small table.

Nulls: rows without conv_id belong to no dialogue and are left out; a null role is the
participant "unknown", a null text is empty, a null turn comes first. Ties in turn
go by role, then text; repeated rows stay. A dialogue of system turns only has no participant and gives no
rows. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import written

PART_CHARS = 1 << 16
#: Rows that share a range partition, about.
PARTITION_ROWS = 50_000
#: Fixed values of the format.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, role, text, at: characters of the dialogue before the turn (roles and marks counted)."""
    rows = turns.filter("conv_id is not null").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ["turn", "role", "text"]
    parts = max(turns.sparkSession.sparkContext.defaultParallelism, math.ceil(turns.count() / PARTITION_ROWS))
    # written, so that partition numbers stay the same whatever is computed again
    ranged = written(rows.repartitionByRange(parts, "conv_id", *order).withColumn("_part", F.spark_partition_id()), "turns")
    size = F.length("role") + F.length("text") + len(BEGIN) + len(END) + 1
    within = Window.partitionBy("conv_id", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("_own", F.coalesce(F.sum(size).over(within), F.lit(0)))
    totals = ranged.groupBy("conv_id", "_part").agg(F.sum(size).alias("_size"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    placed = own.join(written(before, "before"), ["conv_id", "_part"])
    return placed.select("conv_id", "role", "text", (F.col("_before") + F.col("_own")).alias("at"))


def rotate(turns: DataFrame, part_chars: int | None = PART_CHARS) -> DataFrame:
    """conv_id, speaker, part, n_turns, text and masks: array of (start, end) in the part's text.

    A part begins with the first turn at or after a multiple of ``part_chars`` characters,
    roles and marks counted; None leaves dialogues whole, each gathered by one task.
    """
    if part_chars is not None and part_chars < 1:
        raise ValueError("part_chars is at least 1, or None")
    placed = written(placed_turns(turns), "placed")
    speakers = placed.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("speaker")).distinct()
    # written, so that the join reads plain exchanges and adaptive execution splits a hot dialogue
    views = placed.join(written(speakers, "speakers"), "conv_id")
    own = F.col("role") == F.col("speaker")
    head = F.when(own, "assistant").when(F.col("role") == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), "role"))
    message = F.struct(
        "at",
        F.concat(F.lit(BEGIN), head, F.lit("\n")).alias("head"),
        F.concat("text", F.lit(END)).alias("body"),
        own.alias("own"),
    )
    part = (F.lit(0) if part_chars is None else F.floor(F.col("at") / part_chars).cast("int")).alias("part")
    grouped = views.groupBy("conv_id", "speaker", part).agg(F.sort_array(F.collect_list(message)).alias("_turns"))

    def step(acc, m):
        start = acc["at"] + F.length(m["head"])
        end = start + F.length(m["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(m["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    masks = F.aggregate("_turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    text = F.array_join(F.transform("_turns", lambda m: F.concat(m["head"], m["body"])), "")
    return grouped.select(
        "conv_id", "speaker", "part", F.size("_turns").cast("long").alias("n_turns"), text.alias("text"), masks.alias("masks")
    )
