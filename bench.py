"""Time the headline queries on local cores and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from spanwatch.plans.queries import all_queries  # noqa: E402
from spanwatch.session import SETTINGS  # noqa: E402

HEADLINE = [
    "strain_temp",
    "strain_temp_bins",
    "temps_col",
    "temps_col_bins",
    "temps_arch",
    "temps_arch_bins",
    "accel_minute",
    "accel_daily_grid",
    "accel_day_range",
    "fft_points",
    "fft_kde",
    "fft_peak",
    "fft_main_series",
    "flatten_accel",
    "flatten_sst",
    "flatten_fft_arrays",
    "weekly_merge",
    "diff_full_outer",
    "diff_except",
    "timestamp_presence",
    "coverage_missing",
    "weekly_backfill",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spanwatch-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    queries = all_queries()
    seconds = {}
    for name in names:
        best = None
        # The first run compiles the plan's code; it is not counted.
        for run in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
            if run > 0:
                best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    result = {
        "metric": "headline queries, best of warm runs, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
