"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median counts.
Results are computed in full and thrown away (``noop``), so no collection to
the driver is timed.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import workload

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "dedupe_by_key",
    "row_hash",
    "diff_classified",
    "diff_summary",
    "diff_repeated_keys",
    "reverse_log",
    "reverse_log_yearly",
    "as_of_mid",
    "as_of_many",
    "report_metrics",
    "snapshot_metrics",
    "compare_metrics",
    "reconcile_extra",
    "rows_per_prefix",
    "ingest_summaries",
    "backfill_as_of_many",
]


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    workload.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = session(scratch)
    seconds = {}
    for name in HEADLINE:
        timed(spark, name)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
