"""Price model from sufficient statistics: equal to MLlib's fits, defined on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import gram as G
from lodgeframe.operators import model as M

FEATURES = ("x", "z", "far", "neighbourhood_index", "room_type_index")


def _cleaned(spark, n=900):
    """Listings with ties between labels, labels missing from some folds and NULL labels."""
    rows = [(i * 1_000_003, float(i % 7), float((i * 31) % 11), 49.0 + (i * 13 % 17) / 100.0,
             None if i % 41 == 0 else f"area {i * i % 23}" if i % 50 else f"rare {i}",
             ("Private room", "Shared room", "Entire home")[i * 7 % 5 % 3],
             float(40 + (i * 37) % 90 + 5 * (i % 7))) for i in range(1, n)]
    return spark.createDataFrame(rows, "id long, x double, z double, far double, "
                                 "neighbourhood_cleansed string, room_type string, price double")


def test_tuning_equals_mllib(spark):
    df = _cleaned(spark)
    model, got = G.tune(df, features=FEATURES)
    _, want = M.tune_price_model(df, features=FEATURES)
    got, want = got.collect(), want.collect()
    assert len(got) == len(want) == len(M.CV_REG_PARAMS)
    for a, b in zip(got, want):
        assert (a["reg_param"], a["is_best"]) == (b["reg_param"], b["is_best"])
        for c in ("cv_rmse", "train_rmse", "validation_rmse"):
            assert a[c] == (None if b[c] is None else pytest.approx(b[c], rel=1e-9))
    held = M.hash_split(M.log_label(df), "id")[1]
    best = next(r for r in got if r["is_best"])
    assert M.rmse(model.transform(held)).first()["rmse"] == pytest.approx(
        best["validation_rmse"], rel=1e-9)


@pytest.mark.parametrize("features", [FEATURES, ("x", "room_type_index"), ("z", "x"), ("far",)])
def test_fit_equals_mllib(spark, features):
    df = _cleaned(spark)
    model, held = G.fit(df, features=features)
    train, valid = M.hash_split(M.log_label(df), "id")
    want = M.price_pipeline(features=features, handle_invalid="keep").fit(train)
    assert list(model.coefficients) == pytest.approx(list(want.stages[-1].coefficients), rel=1e-7)
    expected = {r["id"]: r["prediction"] for r in want.transform(valid).collect()}
    found = {r["id"]: r["prediction"] for r in held.collect()}
    assert found.keys() == expected.keys()
    assert all(found[i] == pytest.approx(expected[i], rel=1e-9) for i in found)


def test_moments_pool_like_the_whole(spark):
    data = G.labelled(_cleaned(spark), features=FEATURES)
    moments, indexes, sizes = G.fold_moments(data, FEATURES)
    pooled = G._pool(moments, G.ALL, 0, range(M.CV_FOLDS))
    table = indexes.where("variant = -1")
    assert sizes["room_type", G.ALL] == table.where("column_name = 'room_type'").count() == 3
    model = G.PriceModel(FEATURES, np.zeros(5), 0.0, table.drop("variant"),
                         {c: sizes[c, G.ALL] for c, _ in M.CATEGORICAL})
    rows = model.transform(data.where("_part = 0")).select(*FEATURES, M.LABEL).toPandas().to_numpy()
    assert pooled.n == len(rows)
    assert pooled.mean == pytest.approx(rows.mean(axis=0), rel=1e-12)
    assert pooled.products / pooled.n == pytest.approx(np.cov(rows.T, bias=True), rel=1e-7, abs=1e-9)


def test_constant_feature_and_constant_label(spark):
    df = _cleaned(spark).withColumn("z", F.lit(3.0))
    model, _ = G.fit(df, features=("x", "z"))
    assert model.coefficients[1] == 0 and model.coefficients[0] != 0
    flat, held = G.fit(df.withColumn("price", F.lit(50.0)), features=("x", "z"))
    assert not flat.coefficients.any()
    assert {round(r["prediction"], 9) for r in held.collect()} == {round(float(np.log(50.0)), 9)}


def test_features_far_from_zero(spark):
    """A shift of a feature changes nothing but the intercept, however far it goes."""
    df = _cleaned(spark)
    near, _ = G.fit(df, features=("x", "far"))
    away, _ = G.fit(df.withColumn("far", F.col("far") + 1e6), features=("x", "far"))
    assert list(away.coefficients) == pytest.approx(list(near.coefficients), rel=1e-6)


def test_null_features_empty_tables_and_lines(spark):
    df = _cleaned(spark)
    holes = df.withColumn("x", F.when(F.col("id") % 10 != 3, F.col("x")))
    model, held = G.fit(holes, features=("x", "z", "room_type_index"))
    whole, _ = G.fit(holes.where("x IS NOT NULL"), features=("x", "z", "room_type_index"))
    assert list(model.coefficients) == pytest.approx(list(whole.coefficients), rel=1e-12)
    scored = model.transform(holes)
    assert scored.where("prediction IS NULL").count() == holes.where("x IS NULL").count() > 0
    with pytest.raises(ValueError, match="no row"):
        G.fit(df.limit(0), features=("x", "z"))
    both = model.lines(held, along="x").withColumn("again", F.expr("intercept - slope * x"))
    assert all(r["again"] == pytest.approx(r["prediction"], rel=1e-12) for r in both.collect())


def test_result_does_not_depend_on_partitioning(spark):
    df = _cleaned(spark)
    a, b = (G.fit(df.repartition(n), features=FEATURES)[0] for n in (1, 9))
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), rel=1e-9)
