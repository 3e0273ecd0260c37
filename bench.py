"""Headline timings.

Runs the main queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line.  Each query is executed in
full with the ``noop`` sink (no driver collection); the first query also
warms the JVM, so every query runs once untimed first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelle.plans.queries import QUERIES  # noqa: E402
from parcelle.session import get_spark  # noqa: E402

HEADLINE = [
    "price_by_type_year",   # flagship: clean → roll-up → price/m² → median
    "mutation_rollup",
    "radius_poi_counts",
    "knn_weighted",
    "quartiles",
    "robust_scaled",
    "region_sales",
    "baseline_metrics",
    "preprocess_pipeline",  # end to end: + kNN + isolation forest
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="parcelle-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    times = {}
    for name in only:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
