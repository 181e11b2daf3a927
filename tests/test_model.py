"""Model operators: label order, deterministic split, closed-form GLM facts, ALS shapes."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import model as M
from lodgeframe.operators import recommend as R


def test_label_index_tie_rule(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "v string")
    got = {r["value"]: r["index"] for r in M.label_index(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_label_index_of_many_labels_matches_the_encoder(spark):
    from pyspark.ml.feature import StringIndexer
    df = spark.range(30_000).select(F.when(F.col("id") % 11 > 0, F.concat(
        F.lit("label "), (F.col("id") * F.col("id") % 9_973).cast("string"))).alias("c"))
    model = StringIndexer(inputCol="c", outputCol="i", handleInvalid="skip").fit(df)
    want = dict(zip(model.labels, range(len(model.labels))))
    assert len(want) > 4_000
    assert {r["value"]: r["index"] for r in M.label_index(df, "c").collect()} == want
    assert M.label_index(df.limit(0), "c").count() == 0


def test_hash_split_is_deterministic_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a1, b1 = M.hash_split(df, "k")
    a2, b2 = M.hash_split(df.repartition(7), "k")
    assert sorted(r[0] for r in a1.collect()) == sorted(r[0] for r in a2.collect())
    assert a1.count() + b1.count() == 1000
    assert a1.join(b1, "k").count() == 0


def test_glm_max_iter_has_no_effect_and_one_feature_formula(spark):
    rows = [(i, float(i % 7) / 10.0, float(50 + (i * 37) % 90)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, price double")
    fit = M.one_feature_ridge(df, "x").first()
    stats = df.select(F.col("x"), F.log("price").alias("y")).agg(
        F.regr_slope("y", "x").alias("s"), F.stddev_pop("y").alias("sy"),
        F.avg("x").alias("mx"), F.avg("y").alias("my")).first()
    slope = stats["s"] / (1 + M.GLM_REG_PARAM / stats["sy"])
    assert fit["slope"] == pytest.approx(slope, rel=1e-8)
    assert fit["intercept"] == pytest.approx(stats["my"] - slope * stats["mx"], rel=1e-8)


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(10)] + [(2, 0, 1.0)],
                               "u long, item long, s double")
    out = R.top_k_per_group(df, "u", [F.col("s").desc(), F.col("item")], 3)
    got = sorted((r["u"], r["item"], r["rank"]) for r in out.collect())
    assert got == [(1, 7, 3), (1, 8, 2), (1, 9, 1), (2, 0, 1)]


def test_als_recommend_shape(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(20) for i in range(15)]
    scores = spark.createDataFrame(rows, "reviewer_id long, listing_id long, score double")
    rec = R.recommend(scores, k=3, max_iter=5)
    counts = {r["reviewer_id"]: r["count"] for r in rec.groupBy("reviewer_id").count().collect()}
    assert counts and all(c == 3 for c in counts.values())
    assert set(rec.columns) == {"reviewer_id", "listing_id", "rating"}


def test_glm_closed_form_ignores_max_iter(spark):
    rows = [(i, float(i % 5), float((i * 7) % 11), float(40 + (i * 13) % 70)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, price double")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features") \
        .transform(M.log_label(df))
    fits = [GeneralizedLinearRegression(labelCol="label", family="gaussian", link="identity",
                                        regParam=0.01, maxIter=m).fit(data) for m in (0, 25)]
    assert list(fits[0].coefficients) == pytest.approx(list(fits[1].coefficients), rel=1e-12)
    assert fits[0].intercept == pytest.approx(fits[1].intercept, rel=1e-12)


def test_hash_split_takes_ids_of_any_size(spark):
    ids = [-7, 0, 5, 123456789, 987654321012345678, 2 ** 63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    a, b = ([r["k"] for r in p.collect()] for p in M.hash_split(df, "k"))
    assert sorted(a + b) == sorted(ids)
    assert sorted(a) == sorted(i for i in ids if (i * 48271 + 5) % 100 < 80)


def _listings(spark, n=300):
    rows = [(i * 1_000_003, float(i % 7), float((i * 31) % 11), float(40 + (i * 37) % 90))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, z double, price double")


def test_tuning_does_not_depend_on_partitioning(spark):
    df = _listings(spark)
    got = []
    for n in (2, 7):
        _, table = M.tune_price_model(df.repartition(n), features=("x", "z"))
        got.append([tuple(r) for r in table.collect()])
    assert len(got[0]) == len(M.CV_REG_PARAMS)
    for a, b in zip(*got):
        assert a[0] == b[0] and a[2] == b[2]
        assert a[1] == pytest.approx(b[1], rel=1e-9)
    best = [r for r in got[0] if r[2]]
    assert len(best) == 1 and best[0][1] == min(r[1] for r in got[0])
    assert best[0][3] > 0 and best[0][4] > 0
    assert all(r[3] is None and r[4] is None for r in got[0] if not r[2])


def test_tuned_model_scores_as_reported(spark):
    df = _listings(spark)
    model, table = M.tune_price_model(df, features=("x", "z"))
    best = table.where("is_best").first()
    train, held = M.hash_split(M.log_label(df), "id", (0.8, 0.2), 5)
    assert M.rmse(M.score(model, train)).first()["rmse"] == pytest.approx(best["train_rmse"])
    assert M.rmse(M.score(model, held)).first()["rmse"] == pytest.approx(best["validation_rmse"])


def _scores_frame(spark, base=600_000_000_000_000_000):
    rows = [(u * 40 + i, base + u, i, float((u * 7 + i * 3) % 5))
            for u in range(20) for i in range(15)]
    return spark.createDataFrame(rows, "id long, reviewer_id long, listing_id long, score double")


def test_dense_ids(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, None, -3, 2 ** 62, 7]], "k long")
    got = {r["k"]: r["i"] for r in R.dense_ids(df, "k", "i").collect()}
    assert set(got) == {5, -3, 2 ** 62, 7} and sorted(got.values()) == [0, 1, 2, 3]


def test_recommend_keeps_64_bit_ids_and_serves_given_users(spark):
    s = _scores_frame(spark)
    base = 600_000_000_000_000_000
    users = spark.createDataFrame([(base + 3,), (base + 4,), (base + 3,), (99,)], "reviewer_id long")
    some = [tuple(r) for r in R.recommend(s, users, k=4, max_iter=5).collect()]
    every = {tuple(r)[:2] for r in R.recommend(s, k=4, max_iter=5).collect()}
    assert len(some) == 8 and {r[0] for r in some} == {base + 3, base + 4}
    assert len(every) == 80 and {r[:2] for r in some} <= every


def test_equal_ratings_spread_over_the_split(spark):
    rows = [(i, 1, 1, 3.0) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, reviewer_id long, listing_id long, score double")
    n = [p.count() for p in R.split_ratings(R.ratings(df))]
    assert sum(n) == 500 and n[0] == 300 and n[1] == n[2] == 100


def test_als_grid_reports_each_setting_and_the_best(spark):
    out = R.als_grid(_scores_frame(spark), max_iters=(2, 4), ranks=(2,), reg_params=(0.1, 1.0)).collect()
    valid = [r for r in out if r["stage"] == "validation"]
    test = [r for r in out if r["stage"] == "test"]
    assert [(r["max_iter"], r["rank"], r["reg_param"]) for r in valid] == [
        (2, 2, 0.1), (2, 2, 1.0), (4, 2, 0.1), (4, 2, 1.0)]
    best = min(valid, key=lambda r: r["rmse"])
    assert len(test) == 1 and (test[0]["max_iter"], test[0]["reg_param"]) == \
        (best["max_iter"], best["reg_param"])
    assert all(0 < r["rmse"] < 5 for r in out)
