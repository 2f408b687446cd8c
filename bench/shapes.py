"""This library's own alternatives against each other, on equal data.

    python bench/shapes.py          all cases, each in its own process
    python bench/shapes.py CASE     one case in this process

Prints one JSON line per case and way with the median seconds of three runs
after a warm-up, and the shuffle bytes and tasks of one run.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import shutil
import statistics
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

import tidemark as tm
import workload

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session(scratch: str) -> SparkSession:
    os.makedirs(f"{scratch}/events")
    settings = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        # At scale neither side of these joins is small.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{scratch}/events",
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
    }
    spark = SparkSession.builder.master(f"local[{CPUS}]").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_so_far(scratch: str) -> tuple[int, int]:
    """Shuffle bytes written and tasks run so far in this process."""
    time.sleep(1)  # the log lags a little behind
    total = tasks = 0
    for path in glob.glob(f"{scratch}/events/*"):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                if '"SparkListenerTaskEnd"' in line:
                    written = (json.loads(line).get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                    total += written.get("Shuffle Bytes Written", 0)
                    tasks += 1
    return total, tasks


def run_out(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def compare(spark: SparkSession):
    """A promise of unique keys against a comparison of multisets."""
    sides = workload.pair(spark, SF_DIR)
    return {
        "unique_keys": lambda: run_out(tm.compare(*sides, workload.PAIR, unique_keys=True)),
        "multisets": lambda: run_out(tm.compare(*sides, workload.PAIR)),
    }


def history(spark: SparkSession):
    """A day at a time against all days at once."""
    return {
        "ingest": lambda: workload.yearly_store(spark, SF_DIR).summaries().collect(),
        "backfill_long": lambda: yearly_at_once(spark).summaries().collect(),
    }


def yearly_at_once(spark: SparkSession) -> tm.HistoryStore:
    dumps = workload.yearly(workload.table(spark, SF_DIR, "orders"))
    root = workload.scratch_folder(spark)
    store = tm.HistoryStore(spark, root, dumps.drop("day").schema, ["o_custkey"])
    store.backfill_long(dumps)
    return store


def rebuild(spark: SparkSession):
    """One query per day against one query for all, by how many days are wanted."""
    store = yearly_at_once(spark)
    last = dt.date(1998, 12, 31)
    wanted = {n: [last - dt.timedelta(i) for i in range(n)] for n in (3, 1000)}
    return {
        "as_of_3": lambda: [run_out(store.as_of(d)) for d in wanted[3]],
        "as_of_many_3": lambda: run_out(store.as_of_many(wanted[3])),
        "as_of_many_1000": lambda: run_out(store.as_of_many(wanted[1000]).filter("as_of IS NULL")),
    }


CASES = {f.__name__: f for f in (compare, history, rebuild)}


def main(name: str) -> None:
    scratch = tempfile.mkdtemp(prefix="tidemark-shapes-")
    spark = session(scratch)
    for way, run in CASES[name](spark).items():
        run()
        seconds = []
        for _ in range(RUNS):
            before = work_so_far(scratch)
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        after = work_so_far(scratch)
        found = {
            "case": name,
            "way": way,
            "median_sec": round(statistics.median(seconds), 2),
            "shuffle_mb": round((after[0] - before[0]) / 1e6, 2),
            "tasks": after[1] - before[1],
        }
        print(json.dumps(found), flush=True)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    if len(sys.argv) == 2:
        main(sys.argv[1])
    else:
        for case in CASES:
            subprocess.run([sys.executable, __file__, case], check=True)
