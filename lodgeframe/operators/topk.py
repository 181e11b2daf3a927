"""Exact top-k inner products between two tables of vectors, without scoring all pairs.

Items are ranked by length (Euclidean norm) and cut into blocks of ``block_items``, longest
first. No product of a user with an item of a block exceeds the product of the user's
length and the block's longest item. Rounds take 1, 1, 2, 4, ... blocks; a user meets a
block only while that bound reaches its k-th best score so far, so most users stop after
the first rounds, and the number of rounds grows with the logarithm of the blocks.

A task scores one tile (about ``tile_users`` users) against one block. Only the best k of
a user leave a tile, and the window that merges them keeps k a user before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.operators.util import materialize, prefix_sums

BLOCK_ITEMS = 4096
TILE_USERS = 1024
SLACK = 1e-9        # relative: rounding of lengths and products never hides a pair


def _norm(c: str) -> Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up in the same order for every pair."""
    out = np.zeros((len(users), len(items)))
    for j in range(users.shape[1] if len(users) else 0):
        out += users[:, j, None] * items[None, :, j]
    return out


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's k largest entries; of equal ones the first."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, dtype=bool)
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    above, tied = scores > least, scores == least
    room = k - above.sum(axis=1, keepdims=True)
    return above | (tied & (np.cumsum(tied, axis=1) <= room))


def _score(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for tile, block in zip(b["tile_rows"], b["items"]):
                s = products(np.array([list(r["f"]) for r in tile], dtype=np.float64),
                             np.array([list(r["f"]) for r in block], dtype=np.float64))
                reached = np.array([-np.inf if r["kth"] is None else r["kth"] for r in tile])
                u, i = np.nonzero(best_of(s, k) & (s >= reached[:, None]))
                yield pd.DataFrame({
                    "user": np.array([r["user"] for r in tile], dtype=np.int64)[u],
                    "item": np.array([r["item"] for r in block], dtype=np.int64)[i],
                    "score": s[u, i]})
    return run


def top_products(users: DataFrame, items: DataFrame, k: int, block_items: int = BLOCK_ITEMS,
                 tile_users: int = TILE_USERS, report: dict | None = None) -> DataFrame:
    """(user, item, score): the k items of largest inner product for every user.

    ``users`` is (user, f), ``items`` (item, f), ids integers and distinct, ``f`` arrays of one
    length. Ties go to the smaller item; fewer than k items give all of them; empty tables
    an empty result. Rows with a null id or vector take no part. ``report``, if given,
    receives ``scored`` (pairs scored) and ``rounds``.
    """
    spark = users.sparkSession
    v = items.select(F.col("item").cast("long"), "f").where("item IS NOT NULL AND f IS NOT NULL")
    v = prefix_sums(v.withColumn("norm", _norm("f")), [-F.col("norm"), F.col("item")],
                    F.lit(1), "rank")
    blocks = materialize(v.withColumn("block", F.floor(F.col("rank") / block_items).cast("int"))
                         .groupBy("block").agg(
                             F.array_sort(F.collect_list(F.struct("item", "f"))).alias("items"),
                             F.max("norm").alias("longest")))
    bounds = blocks.select("block", "longest", F.size("items").alias("n"))
    n_blocks = blocks.count()
    u = users.select(F.col("user").cast("long"), "f").where("user IS NOT NULL AND f IS NOT NULL")
    u = materialize(u.withColumn("norm", _norm("f")))
    tiles = u.count() // tile_users + 1
    u = u.withColumn("tile", F.pmod(F.xxhash64("user"), F.lit(tiles)))
    order = W.partitionBy("user").orderBy(F.desc("score"), "item")
    best = spark.createDataFrame([], "user long, item long, score double")
    low, high, scored, rounds = 0, 1, 0, 0
    while low < n_blocks:
        high = min(high, n_blocks)
        reached = best.groupBy("user").agg(F.count("*").alias("_n"), F.min("score").alias("_s")) \
            .select("user", F.when(F.col("_n") >= k, F.col("_s")).alias("kth"))
        # Bounds fall from block to block, so a user left out here needs no later round.
        near = bounds.where((F.col("block") >= low) & (F.col("block") < high))
        needs = u.join(reached, "user", "left").withColumn(
            "block", F.explode(F.sequence(F.lit(low), F.lit(high - 1)))).join(near, "block")
        bound = F.col("norm") * F.col("longest") * (1 + SLACK)
        needs = needs.where(F.col("kth").isNull() | (bound >= F.col("kth")))
        if rounds:
            needs = materialize(needs.select("block", "tile", "user", "f", "kth", "n"))
            met = needs.agg(F.sum("n")).first()[0]
            if met is None:
                break
            scored += met
        elif report is not None:
            scored += needs.agg(F.sum("n")).first()[0] or 0
        met = needs.groupBy("block", "tile").agg(
            F.collect_list(F.struct("user", "f", "kth")).alias("tile_rows")).join(
            blocks.select("block", "items"), "block")
        got = met.select("tile_rows", "items").mapInPandas(
            _score(k), "user long, item long, score double")
        best = materialize(best.unionByName(got).withColumn(
            "_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r"))
        low, high, rounds = high, 2 * high, rounds + 1
    if report is not None:
        report.update(scored=scored, rounds=rounds)
    return best
