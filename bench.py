"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the tables, the cores and the
number of timed runs after one warm-up run; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tierflow.plans.queries import QUERIES
from tierflow.session import get_session

HEADLINE = [
    "window_load",
    "user_grid",
    "user_gap_rows",
    "hourly_profile",
    "user_imputed",
    "zscores",
    "event_zscores",
    "event_cleaned",
    "anomalies",
    "event_anomalies",
    "event_daily_statistics",
    "user_daily_statistics",
    "standardize",
    "custom_columns",
    "dedupe_all",
    "dedupe_ordered",
    "duplicate_counts",
    "quality_flag",
    "quality_report",
    "business_rules",
    "null_percent",
    "metrics_daily",
    "metrics_hourly",
    "metrics_by_line",
    "hash_token",
    "token_mapping",
    "mask_email",
    "mask_phone_documents",
    "encrypt_roundtrip",
    "upsert",
    "partitioned_write",
    "incremental_ingest",
    "layered_run",
    "turbine_run_statistics",
]


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "tierflow-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds(spark, folder, name)
        timings[name] = round(
            statistics.median(seconds(spark, folder, name) for _ in range(runs)), 3
        )
        print(f"{name} {timings[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
