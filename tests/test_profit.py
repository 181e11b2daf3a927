"""Profit sweep: gap fill, per-price mean, arg-max with ties."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import profit


def _fixed_predict(table):
    """A predict function returning fixed log prices per grid step (for the worked example)."""
    def predict(grid):
        return grid.join(table, "occ_k").withColumn("prediction", F.log(F.col("p")))
    return predict


def test_gap_fill_example(spark):
    # Two grid steps: price 2 at occupancy 0.5 and price 3 at occupancy 0.2.
    hosts = spark.createDataFrame([(1,)], "host_id long")
    table = spark.createDataFrame([(500, 2.5), (200, 3.5)], "occ_k int, p double")
    predict = _fixed_predict(table)
    curve = {r["price"]: (r["future_occupancy"], r["profit"]) for r in
             profit.profit_curve(hosts, predict).collect()}
    assert curve == {0: (1.0, 0.0), 1: (1.0, 30.0), 2: (0.75, 45.0),
                     3: (pytest.approx(0.2), pytest.approx(18.0))}
    best = profit.best_price(hosts, predict).collect()
    assert [(r["price"], r["profit"]) for r in best] == [(2, 45.0)]


def test_best_price_matches_full_curve(spark):
    hosts = spark.createDataFrame([(i, 4.0 + i / 10.0, 1.2) for i in range(30)],
                                  "host_id long, intercept double, slope double")
    pred = profit.closed_form_log_price()
    curve = profit.profit_curve(hosts, pred)
    top = curve.groupBy("host_id").agg(F.max("profit").alias("m"))
    expect = sorted(curve.join(top, "host_id").where(F.col("profit") == F.col("m"))
                    .select("host_id", "price", "profit").collect())
    got = sorted(profit.best_price(hosts, pred).select("host_id", "price", "profit").collect())
    assert got == expect


def test_fill_rows_in_chunks(spark):
    """A lowest price beyond one chunk: every price from 0 has its row, once."""
    hosts = spark.createDataFrame([(1, 9.2, 0.001), (2, 0.0, 0.0)],
                                  "host_id long, intercept double, slope double")
    curve = profit.profit_curve(hosts, profit.closed_form_log_price()).collect()
    prices = sorted(r["price"] for r in curve if r["host_id"] == 1)
    assert prices == list(range(prices[-1] + 1)) and prices[-1] > 2 * profit.FILL_CHUNK
    assert sorted(r["price"] for r in curve if r["host_id"] == 2) == [0, 1]


def test_optimise_drops_requests_without_pois(spark):
    pois = spark.createDataFrame(
        [(i, 49.2, -123.0, c, None) for i, c in enumerate(["bus", "subway", "shopping", "restaurant"])],
        "osm_id long, lat double, lon double, category string, name string")
    requests = spark.createDataFrame([(1, 49.2, -123.0), (2, 40.0, -123.0), (3, None, None)],
                                     "host_id long, lat double, lon double")

    def predict(grid):
        return grid.withColumn("prediction", F.lit(4.0) + F.col("num_shop_2km")
                               - F.col("future_occupancy"))
    best = profit.optimise(requests, pois, predict).collect()
    assert {r["host_id"] for r in best} == {1}
    curve = profit.optimise(requests, pois, predict, whole_curve=True)
    assert curve.agg(F.max("profit")).first()[0] == best[0]["profit"]
