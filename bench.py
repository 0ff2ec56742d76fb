"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores. Every query runs in full into
a sink that discards its rows, so reading results into Python is not part of the time.
"""

from __future__ import annotations

import json
import os
import time

from demandloom.queries import QUERIES
from demandloom.session import local_session
from demandloom.sources import drop_staged

HEADLINE = (
    "clean_transactions", "quantiles", "star_join", "weekly_rollup",
    "weekly_lags_and_ratios", "lags", "rolling",
    "lags_long_series", "weekly_features", "category_apply", "time_split", "time_folds",
    "fold_summary", "horizon_features", "forecast_units", "forecast", "forecast_forest", "training_metrics",
    "rolling_long_series", "ratios_filled", "weekly_rollup_sparse", "trend_weekly",
    "top_categories", "seasonality_week", "forecast_vs_actual", "correlation", "correlation_weekly",
    "error_histogram", "density", "decompose_additive", "decompose_by_store",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    QUERIES["weekly_rollup"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_staged(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
