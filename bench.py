"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is timed from building its DataFrame to the end of a full execution
through the ``noop`` sink (every row computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sunset_engine.plans import catalog  # noqa: E402
from sunset_engine.session import get_spark  # noqa: E402

HEADLINE = [
    "top_airports",           # flagship: near-sunset flights -> counts -> top 50
    "near_sunset_flights",
    "near_sunset_flights_tz",
    "flight_frequencies",
    "strike_counts",
    "strike_per_flight",
    "strike_ratio_left",
    "top_and_bottom",
    "missing_codes",
    "zonal_mean",
    "normalized_raster",
    "training_table",
    "fit_residuals",
    "pearson_p_value",
    "rf_predictions",          # single forest fit (reference setup: 100 trees, depth 5)
    "rf_metrics",              # single fit + RMSE, MSE, MAE, R^2
    "rf_cross_validated",      # 3 x 3 grid, 5 folds, refit: 46 forest fits
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", max(cpus, 8))
    # JVM warm-up, not timed: a small Parquet scan + shuffle aggregate on `region`
    # (a table none of the benchmarked queries reads) loads the reader, codegen and
    # shuffle classes once, so the first timed query is not charged for them.
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).groupBy("r_name").count().collect()
    qs = catalog.queries()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
