"""Seconds per headline query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = (
    "scan_required",
    "duplicate_rows",
    "missing_values",
    "numeric_summary",
    "describe_numeric",
    "numeric_by_supplier",
    "correlation_matrix",
    "histogram",
    "box_stats",
    "data_warnings",
    "stratified_split",
    "threshold_sweep",
    "threshold_sweep_by_user",
    "operating_profiles",
    "operating_profiles_by_priority",
    "evaluate_models",
    "ranking_by_user",
    "roc_curve",
    "outcome_summary",
    "numeric_by_outcome",
    "error_cases",
    "permutation_importance",
    "train_lr",
    "train_gbt",
)


def main() -> None:
    from faultline import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # No Python call site is kept per column: building a query is several times faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = catalog.queries()
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    if names == ["all"]:
        names = list(runs)

    def once(name: str) -> float:
        start = time.perf_counter()
        runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("threshold_sweep")  # starts executors and loads classes
    seconds = {name: round(once(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
