"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_project_parquet", "scan_manifest", "dedupe_records", "daily_median_panel", "consecutive_returns", "profile_features",
    "profile_eligibility", "regular_grid", "demand_features", "quantile_table", "clip_features", "baseline_metrics",
    "day_block_bootstrap", "silhouette_samples", "kmeans_fit", "kmeans_selection", "commodity_overview", "model_logistic", "model_additive",
    "model_comparison", "backtest_metrics",
]


def main() -> None:
    from serieskit.catalog import QUERIES
    from serieskit.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    QUERIES["scan_project_parquet"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "price_rows_per_sec": round(rows / seconds["daily_median_panel"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
