"""Profit-maximising nightly price per host.

For every host request the occupancy grid 0.001 .. 1.000 is generated in-row
(``explode(sequence(1, 1000))``, no join), a price model gives log price per
grid point, prices are truncated to int, integer prices below the lowest
predicted one are filled with occupancy 1.0, rows with the same price are
averaged, and monthly profit = price * occupancy * 30. Occupancy is carried
as integer thousandths so the per-price mean is exact.

All hosts are handled in one job. Requests are hash-partitioned by host before
the grid is generated, so every aggregate and window after it finds its rows in
place: one exchange on the requests, none on the grid, and one evaluation of
grid and model. Fill rows are generated in bounded chunks, never as one array
as long as a price.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.functions.parse import exp_to_int, monthly_profit
from lodgeframe.operators import geo

# Fixed value: grid resolution (occupancy steps of 1 / GRID_STEPS).
GRID_STEPS = 1000
HOST = "host_id"
# Fill rows generated at once.
FILL_CHUNK = 4096


def occupancy_grid(hosts: DataFrame, steps: int = GRID_STEPS) -> DataFrame:
    """S7 + J5: every host row x occupancy k / steps for k = 1..steps (k kept as ``occ_k``)."""
    parts = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = F.explode(F.sequence(F.lit(1), F.lit(steps)))
    return hosts.repartition(parts, HOST).withColumn("occ_k", grid) \
        .withColumn("future_occupancy", F.col("occ_k") / F.lit(float(steps)))


def closed_form_log_price(intercept: str = "intercept", slope: str = "slope") -> Callable:
    """Log-price model ``intercept - slope * occupancy`` as a grid -> predictions function."""
    def predict(grid: DataFrame) -> DataFrame:
        return grid.withColumn(
            "prediction", F.col(intercept) - F.col(slope) * F.col("future_occupancy"))
    return predict


def model_log_price(model) -> Callable:
    """Fitted pipeline model as a grid -> predictions function."""
    return model.transform


def predicted_prices(hosts: DataFrame, predict: Callable, steps: int = GRID_STEPS) -> DataFrame:
    """(host_id, price, occ_k): C18 on every grid prediction."""
    pred = predict(occupancy_grid(hosts, steps))
    return pred.select(HOST, exp_to_int("prediction").alias("price"), "occ_k")


def _mean_occupancy(sum_k: Column, n: Column, steps: int) -> Column:
    return sum_k / n / F.lit(float(steps))


def _price_groups(hosts: DataFrame, predict: Callable, steps: int) -> DataFrame:
    """(host_id, price, _k, _n, _low) per predicted price; _low is the host's lowest price.

    The lowest price gets the fill row with occupancy 1.0 added to its sums.
    """
    pp = predicted_prices(hosts, predict, steps).where(F.col("price").isNotNull())
    groups = pp.groupBy(HOST, "price").agg(F.sum("occ_k").alias("_k"),
                                           F.count(F.lit(1)).alias("_n"))
    low = F.min("price").over(Window.partitionBy(HOST))
    at_low = F.col("price") == F.col("_low")
    return groups.withColumn("_low", low) \
        .withColumn("_k", F.col("_k") + F.when(at_low, F.lit(steps)).otherwise(F.lit(0))) \
        .withColumn("_n", F.col("_n") + F.when(at_low, F.lit(1)).otherwise(F.lit(0)))


def _curve_rows(agg: DataFrame, steps: int) -> DataFrame:
    occ = _mean_occupancy(F.col("_k"), F.col("_n"), steps)
    return agg.select(HOST, "price", occ.alias("future_occupancy"),
                      monthly_profit(F.col("price"), occ).alias("profit"))


def profit_curve(hosts: DataFrame, predict: Callable, steps: int = GRID_STEPS) -> DataFrame:
    """U1 + A10 + C19: (host_id, price, future_occupancy, profit), the whole curve.

    The row of the lowest price also yields the fill rows 0 .. lowest - 1 (occupancy
    1.0), chunk by chunk; chunk -1 is the row itself.
    """
    groups = _price_groups(hosts, predict, steps)
    low, c = F.col("_low"), F.lit(FILL_CHUNK)
    last = F.when((F.col("price") == low) & (low >= 1),
                  F.floor((low - 1) / c).cast("int")).otherwise(F.lit(-1))
    chunked = groups.withColumn("_chunk", F.explode(F.sequence(F.lit(-1), last, F.lit(1))))
    own = F.col("_chunk") == -1
    fill = F.sequence(F.col("_chunk") * c, F.least(F.col("_chunk") * c + c - 1, low - 1))
    price = F.explode(F.when(own, F.array("price")).otherwise(fill))
    rows = chunked.select(HOST, price.alias("price"),
                          F.when(own, F.col("_k")).otherwise(F.lit(steps)).alias("_k"),
                          F.when(own, F.col("_n")).otherwise(F.lit(1)).alias("_n"))
    return _curve_rows(rows, steps)


def best_price(hosts: DataFrame, predict: Callable, steps: int = GRID_STEPS) -> DataFrame:
    """The curve row(s) with the highest profit per host, ties kept.

    Fill rows below the lowest predicted price m have profit 30 * p, rising
    with p, so among them only p = m - 1 can be best. The candidates are
    therefore the predicted price groups plus p = m - 1, without materialising
    the whole fill range; each host has at most ``steps + 1`` of them.
    """
    groups = _price_groups(hosts, predict, steps)
    low = F.col("_low")
    row = F.struct(F.col("price"), F.col("_k").alias("_k"), F.col("_n").alias("_n"))
    below = F.struct((low - 1).alias("price"), F.lit(steps).cast("long").alias("_k"),
                     F.lit(1).cast("long").alias("_n"))
    rows = groups.select(HOST, F.inline(F.when(
        (F.col("price") == low) & (low >= 1), F.array(row, below)).otherwise(F.array(row))))
    curve = _curve_rows(rows, steps)
    w = Window.partitionBy(HOST).orderBy(F.col("profit").desc())
    return curve.withColumn("_r", F.rank().over(w)).where(F.col("_r") == 1).drop("_r")


def optimise(requests: DataFrame, pois: DataFrame, predict: Callable, *,
             whole_curve: bool = False, steps: int = GRID_STEPS) -> DataFrame:
    """M11 end to end, for many requests (host_id, lat, lon, model columns) in one job.

    POI features around each request -> occupancy grid -> model -> best price, or
    the whole curve. As in the original, a request that lacks a POI category
    within its radius gives no row.
    """
    feats = geo.poi_features(requests.select(F.col(HOST).alias("listing_id"), "lat", "lon"), pois)
    ready = requests.join(feats.withColumnRenamed("listing_id", HOST).hint("merge"), HOST)
    return (profit_curve if whole_curve else best_price)(ready, predict, steps)
