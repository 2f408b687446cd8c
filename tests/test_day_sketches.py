"""Sketches of days: united counts near the exact ones, and what is read for them."""

import pytest
from pyspark.sql import functions as F

from tidemark import HistoryStore
from tidemark.operators.day_sketches import day_sketches, united_metrics

from .helpers import day

SCHEMA = "id long, code string, street string"


def dump(spark, first, n):
    return spark.range(first, first + n).selectExpr(
        "id", "concat(lpad(id % 37, 2, '0'), id % 800) AS code", "concat('street ', id % 3001) AS street"
    )


def close(got, exact):
    return abs(got - exact) <= max(1, 4 * 1.04 / 64 * exact)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = HistoryStore(
        spark, str(tmp_path_factory.mktemp("sketches") / "store"), dump(spark, 0, 1).schema, ["id"], sketches=("code", "street")
    )
    for n in range(1, 5):
        store.ingest(day(n), dump(spark, 4000 * n, 10_000))
    store.vacuum()
    return store


def exact(spark, first, last):
    rows = [dump(spark, 4000 * n, 10_000) for n in range(first, last + 1)]
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    return every.agg(
        F.count_distinct("id"), F.count_distinct("code"), F.count_distinct("street"), F.count_distinct(F.substring("code", 1, 2))
    ).first()


@pytest.mark.parametrize(("first", "last"), [(1, 1), (1, 2), (2, 4), (1, 4)])
def test_days_unite(spark, store, first, last):
    got = store.range_report(day(first), day(last)).first()
    truth = exact(spark, first, last)
    assert all(close(g, t) for g, t in zip(got, truth)) and got[3] == truth[3]


def test_by_prefix(spark, store):
    got = {r["prefix"]: r["addresses"] for r in store.range_report(day(1), day(3), by_prefix=True).collect()}
    rows = dump(spark, 4000, 18_000).groupBy(F.substring("code", 1, 2)).count().collect()
    assert len(got) == 37 and all(close(got[p], n) for p, n in rows)


def test_nothing_but_sketches_is_read(store):
    files = store.range_report(day(1), day(4)).inputFiles()
    assert files and all("/sketch/" in f for f in files)


def test_backfill_sketches_each_day(spark, root):
    days = {1: 5000, 2: 0, 3: 7000}
    store = HistoryStore(spark, root, dump(spark, 0, 1).schema, ["id"], sketches=("code", "street"))
    rows = [dump(spark, 0, n).withColumn("day", F.lit(day(d))) for d, n in days.items() if n]
    store.backfill_long(rows[0].unionByName(rows[1]), [day(d) for d in days])
    for d, n in days.items():
        assert close(store.range_report(day(d), day(d)).first()["addresses"], n)
    assert close(store.range_report(day(1), day(3)).first()["addresses"], 7000)
    store.vacuum()
    assert close(store.range_report(day(1), day(1)).first()["addresses"], 5000)


def test_a_day_without_a_sketch_is_refused(spark, root):
    HistoryStore(spark, root, dump(spark, 0, 1).schema, ["id"]).ingest(day(1), dump(spark, 0, 10))
    store = HistoryStore(spark, root, dump(spark, 0, 1).schema, ["id"], sketches=("code", "street"))
    store.ingest(day(2), dump(spark, 0, 20))
    with pytest.raises(LookupError):
        store.range_report(day(1), day(2))
    assert store.range_report(day(2), day(9)).first()["addresses"] == 20
    assert tuple(store.range_report("2024-01-01", "2024-02-01").first()) == (0, 0, 0, 0)


def test_nulls_are_in_no_sketch(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "01", "a"), (2, "01", None)], SCHEMA)
    sketches = day_sketches(rows, ["id"], "code", "street")
    assert tuple(united_metrics(sketches).first()) == (2, 1, 1, 1)
    assert {r["prefix"]: r["n_rows"] for r in sketches.collect()} == {None: 1, "01": 2}
