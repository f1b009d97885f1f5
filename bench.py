"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1) and BENCH_CPUS the number of local threads. Every query
runs once on the smallest data set first, so that compilation and class loading are not counted.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from billtide.plans.queries import all_queries

HEADLINE = [
    "history_dedup",
    "history_merge",
    "history_affected_scan",
    "history_partition_overwrite",
    "bronze_json_roundtrip",
    "bronze_incremental",
    "current_state",
    "refresh_current",
    "state_as_of",
    "state_intervals",
    "kpi_flow_daily",
    "kpi_stock_daily",
    "kpi_daily",
    "kpi_daily_incremental",
    "kpi_by_differences",
    "recon_current_vs_history",
    "recon_kpi_vs_current",
    "dq_bronze_summary",
    "dq_history_summary",
    "dq_duplicate_keys",
    "dq_invalid_values",
    "dq_plan_mismatch",
    "illegal_transitions",
    "plan_step_mismatches",
    "out_of_order_events",
    "jobs_kpi_daily",
]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # no stack trace per column expression: it is for interactive debugging
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or HEADLINE
    smallest = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm_up = smallest if os.path.isdir(smallest) else sf_dir
    for name in names:
        run(queries[name](spark, warm_up))
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
