"""Time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` holds seconds per query, the median of $BENCH_RUNS runs after a warm-up (one run if that took over 10 s).
``setup`` holds what is derived once per session before them, the fact table first of all, and counts towards the total.
``mart`` times the order-grain variants of the queries that have one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trolley.plans import retail  # noqa: E402
from trolley.plans.mart import MART_QUERIES, order_mart  # noqa: E402
from trolley.plans.registry import QUERIES  # noqa: E402
from trolley.workspace import workspace  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LONG_SECONDS = 10


def execute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_seconds(action) -> float:
    """The median after a warm-up; of what takes long even then, whole loads and streams, one run."""
    runs = 1 if seconds(action) > LONG_SECONDS else RUNS
    return round(statistics.median(seconds(action) for _ in range(runs)), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    setup = {
        "fact": round(seconds(lambda: retail.fact(spark, SF_DIR)), 3),
        "payloads": round(seconds(lambda: retail.payload_path(spark, SF_DIR)), 3),
        "mixed_landing": round(seconds(lambda: retail.mixed_landing_path(spark, SF_DIR)), 3),
    }
    setup["serving"] = round(seconds(lambda: QUERIES["loaded_row_count"](spark, SF_DIR)), 3)
    queries = {
        name: median_seconds(lambda query=query: execute(query(spark, SF_DIR))) for name, query in QUERIES.items()
    }
    mart_table = workspace(spark).materialise(order_mart(retail.fact(spark, SF_DIR)), "mart")
    mart = {
        name: median_seconds(lambda query=query: execute(query(mart_table))) for name, query in MART_QUERIES.items()
    }
    report = {
        "metric": "total seconds, all queries plus one-time setup",
        "value": round(sum(queries.values()) + sum(setup.values()), 3),
        "unit": "sec",
        "queries": queries,
        "setup": setup,
        "mart": mart,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
