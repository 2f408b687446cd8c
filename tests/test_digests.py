"""Digests of key ranges, and comparisons that read only what differs."""

import pytest
from pyspark.sql import functions as F

from tidemark import HistoryStore, compare
from tidemark.plans import digests

from .helpers import day, same

SCHEMA = "k long, v string, w double"
BUCKETS, PARTS = 16, 8


def rows(spark, n=400, edits=None):
    """Keys 0 to n - 1; ``edits`` maps keys to another row, to a further one, or to none."""
    values = {k: (f"v{k}", k / 2) for k in range(n)}
    for k, v in (edits or {}).items():
        values.pop(k, None)
        if v is not None:
            values[k] = v
    return spark.createDataFrame([(k, *v) for k, v in values.items()], SCHEMA)


EDITS = {3: ("other", 1.5), 77: None, 1000: ("new", None), 200: ("v200", None)}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("digests") / "store")
    store = HistoryStore(spark, path, rows(spark, 1).schema, ["k"], buckets=BUCKETS, digests=PARTS)
    store.ingest(day(1), rows(spark))
    store.ingest(day(2), rows(spark, edits=EDITS))
    store.ingest(day(3), rows(spark, edits=EDITS))
    store.ingest(day(4), rows(spark, edits={k: (f"all {k}", 0.0) for k in range(400)}))
    return store


def buckets_of(frame):
    return {digests.bucket_of(f.rsplit("/", 1)[-1]) for f in frame.inputFiles()}


def test_equals_a_whole_comparison(spark, store):
    for a, b in ((1, 2), (2, 3), (2, 4), (2, 1)):
        found = store.diff(day(a), day(b))
        assert same(found, compare(store.snapshot(day(a)), store.snapshot(day(b)), ["k"], unique_keys=True))
    assert store.diff(day(1), day(2)).count() == 4


def test_only_unequal_buckets_are_read(spark, store):
    found = store.diff(day(1), day(2))
    touched = spark.createDataFrame([(k,) for k in EDITS], "k long").selectExpr(*digests.places(["k"], BUCKETS, PARTS))
    expected = {r["bucket"] for r in touched.collect()}
    snapshots = {f for f in found.inputFiles() if "/snapshot/" in f}
    assert {digests.bucket_of(f.rsplit("/", 1)[-1]) for f in snapshots} == expected
    assert len(expected) < BUCKETS / 2
    unequal = {(r["bucket"], r["part"]) for r in store.unequal_parts(day(1), day(2)).collect()}
    assert unequal == {(r["bucket"], r["part"]) for r in touched.collect()}
    assert sum(r["rows_after"] - r["rows_before"] for r in store.unequal_parts(day(1), day(2)).collect()) == 0


def test_equal_days_read_nothing(store):
    assert not [f for f in store.diff(day(2), day(3)).inputFiles() if "/snapshot/" in f]
    assert store.unequal_parts(day(2), day(3)).isEmpty()


def test_days_that_differ_everywhere_are_joined_whole(spark, store):
    found = store.diff(day(3), day(4))
    assert buckets_of(found) == set(range(BUCKETS))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_a_bucket_is_where_its_file_says(spark, store):
    path = store.snapshot(day(1)).inputFiles()
    for file in path[:4]:
        read = spark.read.parquet(file).selectExpr(*digests.places(["k"], BUCKETS, PARTS))
        assert {r["bucket"] for r in read.select("bucket").distinct().collect()} == {
            digests.bucket_of(file.rsplit("/", 1)[-1])
        }


def test_digests_do_not_depend_on_the_order(spark):
    table = rows(spark, 300)
    a = digests.digests(table.orderBy("v").coalesce(1), ["k"], 4, 4)
    b = digests.digests(table.orderBy(F.desc("k")).repartition(5), ["k"], 4, 4)
    assert same(a, b)
    assert digests.unequal(a, b).isEmpty()


def test_nulls_move_digests(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, "x", None)], SCHEMA)
    for other in ([(1, "x", 1.0), (2, None, None)], [(1, None, 1.0)], [(1, None, None), (2, "x", 1.0)]):
        found = digests.unequal(
            digests.digests(left, ["k"], 1, 1), digests.digests(spark.createDataFrame(other, SCHEMA), ["k"], 1, 1)
        )
        assert found.count() == 1


def test_digests_of_nothing(spark):
    nothing = digests.digests(rows(spark, 0).limit(0), ["k"], 4, 4)
    assert nothing.isEmpty()
    found = digests.unequal(nothing, digests.digests(rows(spark, 3), ["k"], 1, 1)).collect()
    assert [(r["rows_before"], r["rows_after"]) for r in found] == [(0, 3)]


def test_without_digests_or_with_others(spark, root):
    plain = HistoryStore(spark, root, rows(spark, 1).schema, ["k"], buckets=8)
    plain.ingest(day(1), rows(spark))
    later = HistoryStore(spark, root, plain.schema, ["k"], buckets=8, digests=4)
    later.ingest(day(2), rows(spark, edits=EDITS))
    with pytest.raises(LookupError):
        later.unequal_parts(day(1), day(2))
    assert later.diff(day(1), day(2)).count() == 4
    other = HistoryStore(spark, root, plain.schema, ["k"], buckets=4, digests=4)
    other.ingest(day(3), rows(spark))
    assert other.diff(day(2), day(3)).count() == 4
    with pytest.raises(LookupError):
        other.diff(day(1), "2025-02-01")


def test_vacuum_takes_digests_along(spark, root):
    store = HistoryStore(spark, root, rows(spark, 1).schema, ["k"], buckets=2, digests=4)
    for n in range(1, 5):
        store.ingest(day(n), rows(spark, 20 + n))
    store.vacuum()
    assert store.diff(day(3), day(4)).count() == 1
    assert not spark.read.parquet(f"{root}/digest/day={day(4)}").isEmpty()
    with pytest.raises(Exception):
        spark.read.parquet(f"{root}/digest/day={day(1)}")
