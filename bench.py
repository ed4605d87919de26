"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit",
"queries" {name: median seconds}, "sf", "runs"}.  Each run forces the full
result with the no-op sink (nothing is pulled to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surge.plans.catalog import QUERIES  # noqa: E402
from surge.session import local_session  # noqa: E402

HEADLINE = [
    "health_daily", "weather_clean", "airq_pivot", "panel_merged", "impute_series", "lag_features_frame",
    "features", "temperature_impact", "pm_uplift_by_key", "key_ranking", "corr_matrix", "additive_decompose",
    "winsor_log_series", "classification_metrics", "regression_metrics", "nearest_date_join", "score_capacity",
    "describe_numeric", "rolling_mean_shift", "clf_knn", "src_airq_long",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="surge-bench", memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, parquet footers
    QUERIES["health_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    per_query = {}
    for name in names:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        per_query[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(per_query.values()), 3),
                      "unit": "sec", "queries": per_query, "sf": float(m.group(1)) if m else sf_dir,
                      "runs": runs, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
