"""Time the registered queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names, default: the headline set) select the
tables, the local cores and the queries. Every query runs over all its rows; nothing is cached in between.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import all_queries, lazy_panel  # noqa: E402

HEADLINE = (
    "clean_sales", "data_summary", "chronological_split", "group_lag", "shifted_rolling", "demand_features", "price_features",
    "inventory_features", "manual_features", "materialize_plan", "merge_planned_features", "audit_plan", "baseline_suite",
    "forecast_metrics", "segment_metrics", "forecast_leaderboard", "best_model_registry", "model_matrix", "train_gbt",
    "train_per_product", "loglog_elasticity", "price_plan_forecast", "segment_guardrails", "cross_fit_residuals",
    "dml_elasticity", "elasticity_estimates", "describe", "column_histogram",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", "/tmp/checkpoints")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = chosen.split(",") if chosen else [n for n in HEADLINE if n in queries]
    lazy_panel(spark, folder).write.format("noop").mode("overwrite").save()  # start-up of the JVM and readers
    times: dict[str, float | None] = {}
    for name in names:
        start = time.perf_counter()
        try:
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001 - one failure must not hide the other times
            print(f"{name} failed: {str(error).splitlines()[0][:300]}", file=sys.stderr)
            times[name] = None
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name}))
    spark.stop()


if __name__ == "__main__":
    main()
