"""Listing recommendations with ALS, grid search and per-user top-k."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.operators.model import hash_split
from lodgeframe.operators.topk import top_products
from lodgeframe.operators.util import materialize

USER, ITEM, RATING = "reviewer_id", "listing_id", "score"

# The ALS search grid and the recommendation count.
ALS_MAX_ITERS = (10, 15, 20)
ALS_RANKS = (5, 10, 15)
ALS_REG_PARAMS = (0.1, 0.01, 0.001)
TOP_K = 10
USER_INDEX, ITEM_INDEX = "_user", "_item"
ID_BUCKETS = 1024


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): every distinct id with a dense index from 0, for ids of any type.

    Ids fall into hash buckets; a bucket's first index is the running sum of the
    bucket sizes (``ID_BUCKETS`` rows), and ids are numbered inside their bucket, so
    no single task orders all ids.
    """
    ids = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn(
        "_b", F.pmod(F.xxhash64(col), F.lit(ID_BUCKETS)))
    first = ids.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_first", F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(col)) - 1
    return ids.withColumn("_i", inside).join(first, "_b").select(
        col, (F.col("_first") + F.col("_i")).cast("int").alias(out))


def ratings(scores: DataFrame) -> DataFrame:
    """([id,] reviewer_id, listing_id, score, _user, _item): ALS needs int ids, so every
    reviewer and listing gets a dense index; rows without an id or a score are left out.
    """
    keep = [c for c in ("id",) if c in scores.columns]
    r = scores.select(*keep, USER, ITEM, F.col(RATING).cast("double").alias(RATING)).where(
        F.col(USER).isNotNull() & F.col(ITEM).isNotNull() & F.col(RATING).isNotNull())
    r = materialize(r)
    return materialize(r.join(dense_ids(r, USER, USER_INDEX), USER)
                       .join(dense_ids(r, ITEM, ITEM_INDEX), ITEM))


def als(rank: int, max_iter: int, reg: float, seed: int = 5) -> ALS:
    """M7: explicit, non-negative ALS; unseen users / items dropped at scoring."""
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol=USER_INDEX,
               itemCol=ITEM_INDEX, ratingCol=RATING, nonnegative=True, implicitPrefs=False,
               coldStartStrategy="drop", seed=seed)


def split_ratings(r: DataFrame, seed: int = 5):
    """6/2/2 deterministic split on the rating's review id (without one: user, item, score)."""
    key = F.xxhash64(USER, ITEM, RATING) if "id" not in r.columns else F.col("id")
    keyed = r.withColumn("_k", F.pmod(key, F.lit(2147483647)))
    return [p.drop("_k") for p in hash_split(keyed, "_k", (0.6, 0.2, 0.2), seed)]


def _rmse(model: ALSModel, data: DataFrame) -> float:
    pred = model.transform(data)
    return RegressionEvaluator(metricName="rmse", labelCol=RATING,
                               predictionCol="prediction").evaluate(pred)


def als_grid(scores: DataFrame, seed: int = 5, max_iters=ALS_MAX_ITERS, ranks=ALS_RANKS,
             reg_params=ALS_REG_PARAMS, parallelism: int = 8) -> DataFrame:
    """M8: validation RMSE of every grid point, then test RMSE of the best (refit on train).

    Output rows: one per grid point (``stage='validation'``) plus one
    ``stage='test'`` row for the chosen parameters. If every validation RMSE
    is NaN (nothing scorable), no test row is produced. Grid points are fitted
    ``parallelism`` at a time (concurrent Spark jobs); ties keep grid order.
    """
    r = ratings(scores)
    train, validation, test = [p.cache() for p in split_ratings(r, seed)]
    grid = list(itertools.product(max_iters, ranks, reg_params))

    def run(point):
        it, rank, reg = point
        return _rmse(als(rank, it, reg, seed).fit(train), validation)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        errors = list(pool.map(run, grid))
    rows, best = [], None
    for (it, rank, reg), err in zip(grid, errors):
        rows.append(("validation", it, rank, reg, err))
        if err == err and (best is None or err < best[3]):
            best = (it, rank, reg, err)
    if best is not None:
        it, rank, reg, _ = best
        rows.append(("test", it, rank, reg, _rmse(als(rank, it, reg, seed).fit(train), test)))
    for p in (train, validation, test):
        p.unpersist()
    return scores.sparkSession.createDataFrame(
        rows, "stage string, max_iter int, rank int, reg_param double, rmse double")


def recommend(scores: DataFrame, users: DataFrame | None = None, k: int = TOP_K,
              rank: int = 5, max_iter: int = 20, reg: float = 0.1, seed: int = 5) -> DataFrame:
    """M9 + C24: top-k listings per reviewer as rows (reviewer_id, listing_id, rating).

    ``users`` (a frame with ``reviewer_id``) restricts scoring to those users
    before any product is taken; users without a training rating have
    no rows. The default scores every user. Products stop at a bound
    (``topk.top_products``), so not every user meets every listing; of equal ratings the
    listing with the smaller index goes first.
    """
    r = ratings(scores)
    train = split_ratings(r, seed)[0]
    model = als(rank, max_iter, reg, seed).fit(train)
    names = r.select(USER, USER_INDEX).distinct()
    known = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("f"))
    if users is not None:
        wanted = users.select(USER).distinct().join(names, USER)
        known = known.join(wanted.select(F.col(USER_INDEX).alias("user")), "user", "left_semi")
    recs = top_products(known, model.itemFactors.select(
        F.col("id").alias("item"), F.col("features").alias("f")), k)
    rows = recs.select(F.col("user").alias(USER_INDEX), F.col("item").alias(ITEM_INDEX),
                       F.col("score").cast("float").alias("rating"))
    return rows.join(names, USER_INDEX).join(r.select(ITEM, ITEM_INDEX).distinct(), ITEM_INDEX) \
        .select(USER, ITEM, "rating")


def top_k_per_group(df: DataFrame, group: str, order_cols, k: int) -> DataFrame:
    """First ``k`` rows per group by ``order_cols`` (Column list), ties broken by order.

    Planned with Spark's window group limit: each map task keeps at most ``k``
    rows per group before the shuffle, so a hot group sends at most
    k x (map tasks) rows to its final task.
    """
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
