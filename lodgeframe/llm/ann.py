"""Nearest vectors by a block matrix join with int8 tiles and error bounds.

Queries and candidates are dealt to blocks of bounded size; every (query block,
candidate block) pair is one tile. In a tile, int8 codes of both sides are
multiplied (in float32 over at most 1,024 dimensions at once, which holds these integer
sums exactly, and added up in double precision). With q = s a + e,
c = t b + g the product differs from s t <a, b> by at most |e| |c| + |s a| |g|, so
each approximate score has a bound. A pair survives if its upper bound reaches
the k-th largest lower bound of its query in the tile; only survivors are
recomputed in double precision from the original vectors. The tile keeps the k best
of each query on a heap; the heaps of a query's tiles, k rows each, are merged by a
ranked window that keeps k rows per task before the shuffle. The result is exact.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as query or candidate; vectors of different lengths never
meet; ties go to the smaller id; rows that repeat an id are separate candidates and a
row never finds its own id; a null id takes no part; fewer than k candidates give all;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize

STRIP = 256                 # queries multiplied at once inside a tile
EXACT_DIMS = 1024           # 1,024 products of codes stay below 2^24
HIT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(
        ~bad & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, step, norm of the coded row, norm of the rest) per row."""
    step = np.abs(x).max(axis=1) / 127.0
    step = np.where(step > 0, step, 1.0)
    codes = np.clip(np.rint(x / step[:, None]), -127, 127).astype(np.int8)
    coded = codes * step[:, None]
    return codes, step, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def coded_products(qa: np.ndarray, ct: np.ndarray) -> np.ndarray:
    """Exact products of int8 query codes and (dimension, candidate) codes in float32."""
    out = np.zeros((len(qa), ct.shape[1]))
    for d in range(0, len(ct), EXACT_DIMS):
        out += qa[:, d:d + EXACT_DIMS].astype(np.float32) @ ct[d:d + EXACT_DIMS]
    return out


def tile(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int) -> list:
    """The k best candidates of each query, as (query, candidate, score)."""
    qa, qs, qn, qe = quantise(q)
    ca, cs, _, ce = quantise(c)
    ct = np.ascontiguousarray(ca.astype(np.float32).T)
    c_norm = np.linalg.norm(c, axis=1)
    out = []
    for at in range(0, len(q), STRIP):
        s = slice(at, at + STRIP)
        near = coded_products(qa[s], ct) * qs[s, None] * cs[None, :]
        # Cauchy-Schwarz on the quantisation errors, widened for rounding.
        bound = (qe[s, None] * c_norm[None, :] + qn[s, None] * ce[None, :]) * (1 + 1e-9)
        bound += 1e-12 * (qn[s, None] + qe[s, None]) * c_norm[None, :]
        own = q_id[s, None] == c_id[None, :]
        low = np.where(own, -np.inf, near - bound)
        high = np.where(own, -np.inf, near + bound)
        kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else \
            np.full(len(low), -np.inf)
        alive = (high >= kth[:, None]) & ~own
        for i in range(len(low)):
            j = np.nonzero(alive[i])[0]
            exact = c[j] @ q[at + i]
            best = heapq.nsmallest(k, zip((-exact).tolist(), c_id[j].tolist()))
            out += [(int(q_id[at + i]), v, -s_) for s_, v in best]
    return out


def _stack(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_list()) if len(rows) else np.zeros((0, 0))


def search(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, query_rows: int = 2048,
           block_rows: int = 8192, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query."""
    base = materialize(usable(vectors, id_col, vec_col).withColumn("q", is_query(F.col("id"))))
    n = {r["q"]: r["n"] for r in base.groupBy("q").agg(F.count("*").alias("n")).collect()}
    n_q = max(1, -(-n.get(True, 0) // query_rows))
    n_c = max(1, -(-sum(n.values()) // block_rows))
    spot = F.xxhash64(F.lit("block"), "id", "v")
    c_block = F.pmod(spot, F.lit(n_c)).cast("int")
    q_block = F.pmod(spot, F.lit(n_q)).cast("int")
    asked = base.where("q").select(
        "id", "v", "dim", q_block.alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"))
    held = base.select(
        "id", "v", "dim", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"),
        c_block.alias("cb"))

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(left) and len(right):
            hits = tile(left["id"].to_numpy(), _stack(left["v"]),
                        right["id"].to_numpy(), _stack(right["v"]), k)
        return pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["dim", "qb", "cb"]
    hits = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(match, HIT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
