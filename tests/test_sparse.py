"""Thin logs: what they hold, and that nothing is lost."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import as_of, reverse_log
from tidemark.operators.sparse import CHANGED, as_of_thin, column_changes, dense_log, thin_log

from .helpers import bag, day, same

SCHEMA = "day date, id long, a string, b long, `c.d` double"


def history(spark, seed, n_days=7, n_keys=25):
    """Dumps of some days; keys come, go, come back and have nulls."""
    draw, state, rows = random.Random(seed), {}, []
    for d in range(1, n_days + 1):
        for k in range(n_keys):
            what = draw.random()
            if what < 0.15:
                state.pop(k, None)
            elif what < 0.35:
                state[k] = [draw.choice([None, "x", "y"]), draw.choice([None, 0, 1]), draw.choice([None, 0.5])]
            elif what < 0.6 and k in state:
                i = draw.randrange(3)
                state[k] = [*state[k][:i], draw.choice([[None, "x", "z"], [None, 0, 7], [None, 1.5]][i]), *state[k][i + 1 :]]
        rows += [(day(d), k, *v) for k, v in state.items()]
    dumps = spark.createDataFrame(rows, SCHEMA)
    days = [day(d) for d in range(1, n_days + 1)]
    return dumps, reverse_log(dumps, ["id"], days), dumps.filter(F.col("day") == day(n_days)).drop("day"), days


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_day_and_the_full_log_come_back(spark, seed):
    dumps, log, snapshot, days = history(spark, seed)
    thin = thin_log(log, snapshot, ["id"]).cache()
    assert same(dense_log(thin, snapshot, ["id"]), log)
    for d in days:
        truth = dumps.filter(F.col("day") == d).drop("day")
        assert same(as_of_thin(snapshot, thin, d, ["id"]), truth)
        assert same(as_of(snapshot, log, d, ["id"]), truth)
    assert as_of_thin(snapshot, thin, "2024-12-31", ["id"]).isEmpty()
    thin.unpersist()


def test_null_is_told_from_unchanged(spark):
    dumps = spark.createDataFrame(
        [(day(1), 1, None, 5, 0.5), (day(2), 1, "x", 5, 0.5), (day(3), 1, "x", None, 0.5), (day(1), 2, "q", None, None)], SCHEMA
    )
    snapshot = dumps.filter(F.col("day") == day(3)).drop("day")
    thin = thin_log(reverse_log(dumps, ["id"]), snapshot, ["id"])
    got = {(r["id"], r["day"].day): (r["action"], r["a"], r["b"], r["c.d"], r[CHANGED]) for r in thin.collect()}
    assert got == {
        (1, 1): ("DELETE", None, None, None, [0]),
        (1, 2): ("UPDATE", None, None, None, [1]),  # a was null
        (1, 3): ("UPDATE", None, 5, None, [2]),
        (2, 1): ("DELETE", None, None, None, [0]),
        (2, 2): ("INSERT", "q", None, None, [7]),
    }


def test_column_changes_count_updates(spark):
    dumps, log, snapshot, _ = history(spark, 4)
    thin = thin_log(log, snapshot, ["id"])
    state, counts = {}, dict.fromkeys(("a", "b", "c.d"), 0)
    for row in dumps.orderBy("id", "day").collect():
        before = state.get(row["id"])
        if before and (row["day"] - before["day"]).days == 1:
            for c in counts:
                counts[c] += row[c] != before[c]
        state[row["id"]] = row
    assert {r["column"]: r["changes"] for r in column_changes(thin, ["id"]).collect()} == counts
    by_day = column_changes(thin, ["id"], ["day"]).groupBy("column").agg(F.sum("changes"))
    assert dict(map(tuple, by_day.collect())) == counts


def test_many_columns(spark):
    """More columns than a word of the bitmap has bits."""
    names = [f"c{i}" for i in range(130)]
    base = spark.range(4).selectExpr("id", *[f"id + {i} AS {n}" for i, n in enumerate(names)])
    later = base.selectExpr("id", *[f"if(id = 1 AND {i} IN (0, 62, 63, 129), NULL, {n}) AS {n}" for i, n in enumerate(names)])
    dumps = base.withColumn("day", F.lit(day(1))).unionByName(later.withColumn("day", F.lit(day(2))))
    log = reverse_log(dumps, ["id"])
    thin = thin_log(log, later, ["id"])
    assert [r[CHANGED] for r in thin.filter("action = 'UPDATE'").collect()] == [[1 | 1 << 62, 1, 1 << 3]]
    assert same(as_of_thin(later, thin, day(1), ["id"]), base)
    assert bag(dense_log(thin, later, ["id"])) == bag(log)


def test_fewer_bytes(spark, tmp_path):
    names = [f"c{i}" for i in range(20)]
    base = spark.range(5000).selectExpr("id", *[f"sha2(concat(id, '{n}'), 256) AS {n}" for n in names])
    later = base.withColumn("c3", F.lit("new"))
    dumps = base.withColumn("day", F.lit(day(1))).unionByName(later.withColumn("day", F.lit(day(2))))
    log = reverse_log(dumps, ["id"]).filter(F.col("day") == day(2))
    thin = thin_log(log, later, ["id"])
    for name, rows in (("full", log), ("thin", thin)):
        rows.coalesce(1).write.parquet(str(tmp_path / name))
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("*.parquet")) for n in os.listdir(tmp_path)}
    assert size["thin"] * 8 < size["full"]
    assert same(as_of_thin(later, spark.read.parquet(str(tmp_path / "thin")), day(1), ["id"]), base)


def test_empty(spark):
    dumps, log, snapshot, _ = history(spark, 5)
    none, thin = log.limit(0), thin_log(log, snapshot, ["id"])
    assert thin_log(none, snapshot, ["id"]).isEmpty()
    assert dense_log(thin.limit(0), snapshot, ["id"]).isEmpty()
    assert same(as_of_thin(snapshot, thin.limit(0), day(1), ["id"]), snapshot)
    assert [r["changes"] for r in column_changes(thin.limit(0), ["id"]).collect()] == [0, 0, 0]


def test_clashing_column_is_refused(spark):
    log = spark.createDataFrame([], "id long, changed string, action string, day date")
    with pytest.raises(ValueError):
        thin_log(log, log.select("id", "changed"), ["id"])
