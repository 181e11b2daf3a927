"""Benchmark: wall time of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed (``write.format("noop")``, so every row is
produced but nothing is collected); the reported time is the median of
``$BENCH_REPEATS`` runs (default 3) after one warm-up run. With ``$BENCH_GROWTH_DIR``
(another scale factor) each query's growth as a power of the scale factor is added.
"""

from __future__ import annotations

import json
import math
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodgeframe.plans.queries import queries  # noqa: E402
from lodgeframe.session import local_session  # noqa: E402

HEADLINE = (
    "cleaned_listing",
    "listing_poi_features_all",
    "radius_pairs",
    "price_by_all_dims",
    "monthly_price",
    "monthly_weather",
    "amenity_frequency",
    "review_score",
    "review_language",
    "profit_curve",
    "best_price",
    "link_catalogue",
)


def _sf(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def timings(spark, qs, names, sf_dir: str, repeats: int) -> dict[str, float]:
    times = {}
    for name in names:
        runs = []
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    small_dir = os.environ.get("BENCH_GROWTH_DIR")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus=os.environ.get("BENCH_CPUS", "*"))
    qs = queries()
    times = timings(spark, qs, names, sf_dir, repeats)
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(sf_dir),
        "cpus": os.environ.get("BENCH_CPUS", "*"),
    }
    if small_dir:
        small = timings(spark, qs, names, small_dir, repeats)
        scale = math.log(_sf(sf_dir) / _sf(small_dir))
        out["growth"] = {"sf": _sf(small_dir), "queries": small, "power": {
            n: round(math.log(times[n] / small[n]) / scale, 2) for n in names}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
