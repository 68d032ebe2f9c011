"""Connected components by alternating large-star and small-star, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v: neighbours are re-linked to the least one.

    The minima are a written table, so that the join back reads two plain exchanges and
    adaptive execution splits a node with very many neighbours.
    """
    both = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(both) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(written(least, "star"), "u")
    if large:
        linked = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pair = F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))
        linked = joined.select(F.explode(pair).alias("p")).select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
    return written(linked.filter("u > v").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its least node.

    Loops and repeated edges are allowed. The number of rounds grows with the logarithm
    of the component sizes; every round's edges are a written table.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(edges.filter("u > v").distinct(), "edges")
    seen = None
    while True:
        edges = _star(_star(edges, large=True), large=False)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
