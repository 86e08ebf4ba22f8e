"""Time the headline queries and print one JSON line."""

import json
import os
import sys
import time

from checks.queries import QUERIES
from motorpool.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "clean_users", "clean_vehicles", "clean_transactions_full",
    "clean_transactions_incremental", "scd2_users_two_batches", "scd2_history_closed_form",
    "fact_transactions", "denormalized_transactions", "users_summary", "vehicles_summary",
    "daily_performance", "daily_top_entities", "pending_window_counts",
    "profile_duplicate_keys",
]


def run(spark, name):
    began = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main():
    # Partition counts for one machine; on a cluster AQE coalesces from a larger start.
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = sorted(run(spark, name) for _ in range(REPEATS))
        seconds[name] = round(times[len(times) // 2], 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
