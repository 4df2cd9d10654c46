"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the test tables, ``BENCH_CPUS`` the number of threads,
``BENCH_QUERIES`` optionally a comma-separated choice. Each query is executed in full into
Spark's no-op sink, once, after one pass over the smallest data that compiles its code (model
fits go without that pass). Ended early by SIGTERM, it prints the times it has.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

from shelfcast.catalog import queries
from shelfcast.session import build_session
from shelfcast.sources import drop_staged

HEADLINE = [
    "scan_sales", "sales_enriched", "launch_calendar", "filter_recent_6m", "product_range", "range_finder",
    "outlier_means", "outlier_flags", "anomaly_table", "rolling_week_sales", "weekly_trend",
    "same_weekday_means", "rolling_weekpart", "sales_features", "same_day_lags", "rolling_stats",
    "lag_feature_table", "weather_codes", "weather_features", "feature_table", "scoring_input",
    "forecast_metrics", "compare_models", "accuracy_by_group", "impute_features", "train_and_evaluate",
    "train_model", "score_single", "score_by_cluster", "score_trees", "score_routed", "score_in_order",
    "fit_stump", "features_from_tail",
]
# Fits of a hundred trees each: run once, on code that the queries before them have compiled.
FITS = {"train_and_evaluate", "train_model", "score_single", "score_by_cluster"}


def run(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "shelfcast-bench",
        int(cpus),
        **{
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            # Recording the Python line of every column expression costs more than the plans.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    times: dict[str, float] = {}

    def ended(*_) -> None:
        report(times, folder)
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for name in names:
        if os.path.isdir(small) and name not in FITS:
            run(registered[name], spark, small)
        times[name] = round(run(registered[name], spark, folder), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    drop_staged(spark)
    spark.stop()
    report(times, folder)


def report(times: dict[str, float], folder: str) -> None:
    total = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec"}
    print(json.dumps(total | {"queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}), flush=True)


if __name__ == "__main__":
    main()
