"""Connected components of an edge table, by alternating star contraction.

Each round is two hash joins and two aggregates over the remaining edges; the
rounds are cut by a written table in the shared folder, so a lost executor
costs one round at most. Nothing is collected but one change counter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: larger neighbours to the least one. Small star: smaller ones and self."""
    if small:
        nbr = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        nbr = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = nbr.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = nbr.join(least, "u")
    if small:
        moved = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        moved = linked.where(F.col("v") > F.col("u")).select(
            F.col("v").alias("a"), F.col("m").alias("b"))
    moved = moved.where(F.col("a") != F.col("b"))
    return moved.distinct() if small else moved      # the small star drops repeats anyway


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the least node.

    Loops and repeated edges are harmless; an empty edge table gives an empty
    result.
    """
    now = materialize(edges.where(F.col("a") != F.col("b")).select("a", "b"))
    before = None
    while True:
        now = materialize(_star(_star(now, small=False), small=True))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
