"""
against a Python UDF, hosts per second of the profit sweep, and candidate pairs per result pair.

Usage: python tools/measure.py [small_dir] [large_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from lodgeframe.functions import parse as P  # noqa: E402
from lodgeframe.functions.geo import haversine_m  # noqa: E402
from lodgeframe.operators import geo, profit  # noqa: E402
from lodgeframe.session import local_session  # noqa: E402
from lodgeframe.sources import fixtures as FX  # noqa: E402


def timed(df) -> float:
    best = None
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        best = took if best is None else min(best, took)
    return best


def main() -> None:
    small, large = (sys.argv[1:] + ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])[:2]
    spark = local_session(cpus=os.environ.get("BENCH_CPUS", "*"))

    def sides(d):
        locs = geo.listing_locations(FX.listings(spark, d))
        pois = geo.poi_table(FX.osm_nodes(spark, d)).select(
            "osm_id", "category", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
        return locs, pois

    for d in (small, large):
        locs, pois = sides(d)
        for r in (2000.0, 5000.0):
            pairs = geo.cell_candidates(locs, pois, r, right_lat="plat", right_lon="plon",
                                        left_key="listing_id", right_key="osm_id")
            n = pairs.agg(F.count(F.lit(1)), F.count_if(F.col("dist") <= r)).first()
            print(f"{d} r={r:.0f}: {n[0]} candidate pairs, {n[1]} within r, of "
                  f"{locs.count() * pois.count()}")
    for d in (small, large):
        locs, pois = sides(d)
        grid = geo.radius_join(locs, pois, 2000.0, right_lat="plat", right_lon="plon",
                               left_key="listing_id", right_key="osm_id")
        # The product is only the yardstick here; no query uses it.
        product = locs.repartition(8).crossJoin(pois).where(
            haversine_m("lat", "lon", "plat", "plon") <= 2000.0)
        print(f"{d} radius join: grid {timed(grid):.2f} s, cross product {timed(product):.2f} s")
    cal = FX.calendar(spark, large).repartition(8)
    udf = F.udf(lambda x: None if x is None else float(x[1:].replace(",", "")), "float")
    print(f"{large} price parsing: native {timed(cal.select(P.price_drop_first('price'))):.2f} s, "
          f"Python UDF {timed(cal.select(udf('price'))):.2f} s")
    hosts = FX.hosts(spark, large)
    took = timed(profit.best_price(hosts, profit.closed_form_log_price()))
    print(f"{large} profit sweep: {hosts.count() / took:.0f} hosts a second, 1000 points each")


if __name__ == "__main__":
    main()
