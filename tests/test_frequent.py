"""Frequent items against a plain count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.frequent import frequency_sketches, frequent_items


def plain(values, per):
    counts = Counter(values)
    return {k: n for k, n in counts.items() if n * per >= len(values)}


def found(rows, items, per, by=()):
    got = frequent_items(rows, frequency_sketches(rows, items, per, by), items, per).collect()
    assert len({r["total"] for r in got}) <= 1
    return {tuple(r[i] for i in items): r["n"] for r in got}


@pytest.mark.parametrize(("per", "power"), [(5, 1.2), (40, 1.05), (300, 0.8)])
@pytest.mark.parametrize("by", [(), ("day",)])
def test_equals_a_plain_count(spark, per, power, by):
    draw = random.Random(per)
    weights = [1 / (i + 1) ** power for i in range(20_000)]
    values = [(k, k % 3) for k in draw.choices(range(20_000), weights, k=60_000)]
    rows = spark.createDataFrame([(i % 7, *v) for i, v in enumerate(values)], "day int, k long, m long").repartition(11)
    truth = plain(values, per)
    assert truth and found(rows, ["k", "m"], per, by) == truth


def test_frequent_over_days_though_not_on_one(spark):
    """Sketches of many days, each with its own noise that outweighs the item."""
    noise = spark.range(100_000).selectExpr("id % 50 AS day", "id + 10 AS k")
    rows = noise.unionByName(spark.range(1100).selectExpr("id % 50 AS day", "5L AS k"))
    assert found(rows, ["k"], 100, ["day"]) == {(5,): 1100}


def test_stored_sketches(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id % 4 AS day", "if(id % 10 < 3, 'hot', string(id)) AS k")
    frequency_sketches(rows, ["k"], 10, ["day"]).write.parquet(str(tmp_path / "s"))
    sketches = spark.read.parquet(str(tmp_path / "s"))
    two = F.col("day") < 2
    got = frequent_items(rows.filter(two), sketches.filter(two), ["k"], 10).collect()
    assert [(r["k"], r["n"], r["total"]) for r in got] == [("hot", rows.filter(two).filter("k = 'hot'").count(), 1500)]


def test_ties_at_the_share(spark):
    """One in four exactly is in; one less is not."""
    values = ["a"] * 25 + ["b"] * 25 + ["c"] * 24 + [f"z{i}" for i in range(26)]
    rows = spark.createDataFrame([(v,) for v in values], "k string")
    assert found(rows, ["k"], 4) == {("a",): 25, ("b",): 25}


def test_nulls_and_likenesses_are_apart(spark):
    rows = spark.createDataFrame([(None, "x")] * 3 + [("null", "x")] * 2 + [("", None)] * 2 + [(None, None)], "`a.b` string, c string")
    assert found(rows, ["a.b", "c"], 4) == {(None, "x"): 3, ("null", "x"): 2, ("", None): 2}


def test_empty(spark):
    rows = spark.createDataFrame([], "day int, k string")
    assert found(rows, ["k"], 10) == {} and found(rows, ["k"], 10, ["day"]) == {}


def test_candidates_are_broadcast_and_rows_stay(spark):
    rows = spark.range(1000).selectExpr("id % 9 AS k")
    plan = frequent_items(rows, frequency_sketches(rows, ["k"], 10), ["k"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("per", [0, 200_000])
def test_share_out_of_range(spark, per):
    with pytest.raises(ValueError):
        frequency_sketches(spark.range(3), ["id"], per)
