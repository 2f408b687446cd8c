"""The store end to end: golden days, re-runs, crashes, retention, evolution."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import ADDRESS_SCHEMA, HistoryStore, compare, diff, integrate, rebuild, report

from tidemark.plans.store import Commit, _estimated_bytes, _may_grow, _plain_scan

from .helpers import (
    address,
    bag,
    base_addresses,
    day,
    frame,
    same,
    short_addresses,
    write_csv,
)


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    """Eleven daily CSV dumps, all alike but for the sixth, ingested in order."""
    folder = tmp_path_factory.mktemp("golden")
    store = HistoryStore(spark, str(folder / "store"))
    for n in range(1, 12):
        rows = short_addresses() if n == 6 else base_addresses()
        name = f"dump-{day(n)}/adresses.csv" if n == 3 else f"dump-{day(n)}.csv"
        path = write_csv(folder / "dumps" / name, rows)
        integrate(store, day(n), path)
    return store, str(folder / "dumps")


def test_golden_log(golden):
    store, _ = golden
    rows = store.log().groupBy("day", "action").count().collect()
    assert {(r["day"], r["action"]): r["count"] for r in rows} == {
        (day(1), "DELETE"): 15,
        (day(6), "INSERT"): 7,
        (day(7), "DELETE"): 7,
    }


def test_golden_summaries(golden):
    store, _ = golden
    got = {r["day"]: tuple(r)[1:] for r in store.summaries().collect()}
    expected = {day(n): (0, 0, 0, 0) for n in range(1, 12)}
    expected.update({day(1): (15, 0, 0, 15), day(6): (0, 0, 7, 7), day(7): (7, 0, 0, 7)})
    assert got == expected


def test_golden_report(golden):
    store, _ = golden
    assert tuple(report(store).first()) == (15, 1, 4, 1)
    assert store.snapshot().select("commune_insee").distinct().first()[0] == "01001"


@pytest.mark.parametrize("n,rows,metrics", [(5, 15, (15, 1, 4, 1)), (6, 8, (8, 1, 3, 1)), (3, 15, None)])
def test_golden_rebuild(golden, tmp_path, n, rows, metrics):
    store, dumps = golden
    result = rebuild(store, day(n), str(tmp_path / "out"), dumps)
    assert result.rebuilt.count() == rows
    assert all(r["agrees"] for r in result.metrics.collect())
    assert result.extra.isEmpty() and result.missing.isEmpty() and result.changes.isEmpty()
    if metrics:
        got = {r["metric"]: r["rebuilt"] for r in result.metrics.collect()}
        assert tuple(got[m] for m in ("addresses", "communes", "streets", "departments")) == metrics


def test_golden_before_first_day(golden):
    store, _ = golden
    assert store.as_of("2024-12-31").isEmpty()


def test_golden_many(golden):
    store, _ = golden
    days = ["2024-12-31", *[day(n) for n in range(1, 12)], "2025-02-01"]
    got = {r["as_of"]: r["count"] for r in store.as_of_many(days).groupBy("as_of").count().collect()}
    expected = {day(n): 8 if n == 6 else 15 for n in range(1, 12)}
    expected[dt.date(2025, 2, 1)] = 15
    assert got == expected


def test_golden_diff(spark, golden, tmp_path):
    store, _ = golden
    for n in (6, 7, 10):
        rebuild(store, day(n), str(tmp_path / f"day={n}"))
    same_days = diff(spark, str(tmp_path / "day=10"), str(tmp_path / "day=7"))
    assert same_days.identical()
    found = diff(spark, str(tmp_path / "day=7"), str(tmp_path / "day=6"))
    assert not found.identical()
    assert tuple(found.summary.first()) == (0, 0, 7, 7)
    assert found.removed.count() == 7 and found.added.isEmpty() and found.modified.isEmpty()
    assert found.removed.columns == ["cle_interop", "commune_nom", "voie_nom", "numero"]
    got = {r["metric"]: (r["before"], r["after"]) for r in found.metrics.collect()}
    assert got == {
        "addresses": (15, 8),
        "communes": (1, 1),
        "streets": (4, 3),
        "departments": (1, 1),
    }


def history_days():
    """Inserts, updates, deletes, a re-insert, null against value, a moving value."""
    one, two, three = address(1), address(2), address(3)
    return {
        day(1): [one, two],
        day(2): [address(1, street="Rue Neuve"), two, three],
        day(4): [address(1, street="Rue Neuve"), address(3, suffixe="bis")],
        day(5): [address(1, street=None), two, address(3, position="bis")],
        day(6): [],
        day(9): [address(1, street=None, code="s1"), address(3)],
    }


def test_every_day_comes_back(spark, root):
    store = HistoryStore(spark, root)
    dumps = {d: frame(spark, rows) for d, rows in history_days().items()}
    store.backfill(dumps)
    assert store.days() == list(dumps)
    for d, dump in dumps.items():
        assert same(store.as_of(d), dump), d
    assert same(store.as_of(day(3)), dumps[day(2)])
    assert same(store.as_of(day(8)), dumps[day(6)])
    many = store.as_of_many(list(dumps))
    for d, dump in dumps.items():
        assert same(many.filter(F.col("as_of") == d).drop("as_of"), dump), d
    updates = store.log().filter("action = 'UPDATE'")
    assert updates.filter(~F.col("cle_interop").startswith("01001_")).isEmpty()
    # A value that moves between two null columns is a change.
    assert store.log(day(4), day(5)).filter("numero = 3").first()["action"] == "UPDATE"


def test_backfill_long_equals_daily_ingest(spark, tmp_path):
    days = history_days()
    daily = HistoryStore(spark, str(tmp_path / "daily"))
    daily.backfill({d: frame(spark, rows) for d, rows in days.items()})
    long = None
    for d, rows in days.items():
        part = frame(spark, rows).withColumn("day", F.lit(d))
        long = part if long is None else long.unionByName(part)
    at_once = HistoryStore(spark, str(tmp_path / "once"))
    at_once.backfill_long(long, days=list(days))
    assert same(at_once.log(), daily.log())
    assert same(at_once.summaries(), daily.summaries())
    assert same(at_once.snapshot(), daily.snapshot())
    for d in [*days, day(3), dt.date(2024, 12, 1)]:
        assert same(at_once.as_of(d), daily.as_of(d)), d
    with pytest.raises(ValueError):
        at_once.backfill_long(long)
    # Redoing the last day right after needs the day before, which is rebuilt.
    redone = frame(spark, [address(7)])
    for store in (at_once, daily):
        store.ingest(day(9), redone)
    assert same(at_once.log(), daily.log())
    assert same(at_once.summaries(), daily.summaries())
    assert same(at_once.as_of(day(5)), frame(spark, days[day(5)]))


def test_backfill_long_refuses_unlisted_days(spark, root):
    long = frame(spark, [address(1)]).withColumn("day", F.lit(day(2)))
    with pytest.raises(ValueError, match="not in the list"):
        HistoryStore(spark, root).backfill_long(long, days=[day(1)])
    with pytest.raises(TypeError):
        HistoryStore(spark, root).backfill_long(long.withColumn("day", F.lit("2025-01-02")))


def test_rerun_is_idempotent_and_corrects(spark, root):
    store = HistoryStore(spark, root)
    store.ingest(day(1), frame(spark, [address(1), address(2)]))
    store.ingest(day(2), frame(spark, [address(1)]))
    before = bag(store.log()), bag(store.summaries())
    store.ingest(day(2), frame(spark, [address(1)]))
    assert (bag(store.log()), bag(store.summaries())) == before
    store.ingest(day(2), frame(spark, [address(1, street="Rue Neuve"), address(2)]))
    assert tuple(store.summaries().filter(F.col("day") == day(2)).first())[1:] == (0, 1, 0, 1)
    assert same(store.as_of(day(1)), frame(spark, [address(1), address(2)]))


def test_older_day_is_refused(spark, root):
    store = HistoryStore(spark, root)
    store.ingest(day(5), frame(spark, [address(1)]))
    with pytest.raises(ValueError):
        store.ingest(day(4), frame(spark, [address(1)]))
    with pytest.raises(ValueError):
        store.ingest("garbage", frame(spark, [address(1)]))
    with pytest.raises(ValueError):
        store.as_of("garbage")


def test_interrupted_day_is_invisible_and_redone(spark, root):
    store = HistoryStore(spark, root)
    first = frame(spark, [address(1)])
    store.ingest(day(1), first)
    store.ingest(day(2), frame(spark, [address(2)]))
    # The run died before its commit: snapshot and log are there, counts are not.
    shutil.rmtree(f"{root}/summary/c=0000000002")
    assert store.days() == [day(1)]
    assert same(store.as_of(day(2)), first)
    assert same(store.snapshot(), first)
    # A later day may follow; the leftover stays invisible.
    store.ingest(day(3), frame(spark, [address(3)]))
    assert same(store.as_of(day(2)), first)
    assert same(store.as_of(day(1)), first)
    assert {r["day"] for r in store.log().collect()} == {day(1), day(3)}


def test_snapshots_are_pruned_and_history_stays(spark, root):
    store = HistoryStore(spark, root, keep=2)
    for n in range(1, 6):
        store.ingest(day(n), frame(spark, [address(n), address(9, numero=n)]))
    assert len(os.listdir(f"{root}/snapshot")) == 5
    store.vacuum()
    assert sorted(os.listdir(f"{root}/snapshot")) == [f"day={day(4)}", f"day={day(5)}"]
    for n in range(1, 6):
        assert same(store.as_of(day(n)), frame(spark, [address(n), address(9, numero=n)]))
    with pytest.raises(LookupError):
        store.snapshot(day(1))


def test_bucket_count_may_change(spark, root):
    rows = [address(n) for n in range(40)]
    HistoryStore(spark, root, buckets=4).ingest(day(1), frame(spark, rows))
    store = HistoryStore(spark, root, buckets=8)
    store.ingest(day(2), frame(spark, rows[5:]))
    assert same(store.as_of(day(1)), frame(spark, rows))
    assert same(store.as_of(day(2)), frame(spark, rows[5:]))


def test_bucket_count_follows_the_size(spark, root):
    store = HistoryStore(spark, root)
    gb = 1 << 30

    def had(buckets):
        return Commit(1, "v", buckets)

    assert store._bucket_count(100, None) == 1
    assert store._bucket_count(100 * gb, None) == 200
    assert store._bucket_count(100 * gb, had(150)) == 150
    assert store._bucket_count(100 * gb, had(50)) == 200
    assert store._bucket_count(40_000 * gb, None) == 80_000
    with pytest.raises(ValueError, match="maxBuckets"):
        store._bucket_count(100_000 * gb, None)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "250000")
    try:
        assert store._bucket_count(100_000 * gb, None) == 200_000
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert HistoryStore(spark, root, buckets=5)._bucket_count(gb, had(9)) == 5


def test_estimates_are_file_sizes(spark, root, tmp_path):
    rows = spark.range(200_000).selectExpr("CAST(id AS STRING) AS k", "id % 7 AS v")
    rows.write.parquet(str(tmp_path / "dump"))
    on_disk = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/dump/*.parquet"))
    assert 0.5 * on_disk <= _estimated_bytes(spark.read.parquet(str(tmp_path / "dump"))) <= 2 * on_disk
    days = rows.selectExpr("*", "date_add(DATE'2025-01-01', CAST(v AS INT)) AS day")
    daily = HistoryStore(spark, f"{root}/daily", rows.schema, ["k"])
    once = HistoryStore(spark, f"{root}/once", rows.schema, ["k"])
    once.backfill_long(days)
    daily.ingest(day(7), rows.filter("v = 6"))
    assert {c.buckets for c in once._committed().values()} == {c.buckets for c in daily._committed().values()} == {1}


def test_a_joined_dump_is_measured(spark, root, tmp_path):
    # 15,000 rows, of which the planner expects the product of two tables.
    orders = spark.range(15_000).selectExpr("id", "id % 1500 AS customer", "repeat('x', 400) AS note")
    customers = spark.range(1500).selectExpr("id AS customer", "repeat('y', 400) AS name")
    for name, rows in (("orders", orders), ("customers", customers)):
        rows.write.option("compression", "uncompressed").option("parquet.enable.dictionary", False).parquet(f"{tmp_path}/{name}")
    joined = spark.read.parquet(f"{tmp_path}/orders").join(spark.read.parquet(f"{tmp_path}/customers"), "customer")
    assert _estimated_bytes(joined) > 4 << 30
    store = HistoryStore(spark, root, joined.schema, ["id"])
    store.ingest(day(1), joined)
    assert [c.buckets for c in store._committed().values()] == [1]
    assert same(store.snapshot(), joined)
    store.ingest(day(2), joined.filter("id < 14000"))
    assert [tuple(r)[1:] for r in store.summaries().orderBy("day").collect()] == [(15000, 0, 0, 15000), (0, 0, 1000, 1000)]


def test_which_plans_are_measured(spark, tmp_path):
    spark.range(10).selectExpr("id", "array(id, id) AS many").write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    assert _plain_scan(scan.filter("id > 2").selectExpr("id + 1 AS id"))
    assert not _plain_scan(scan.join(scan.select("id"), "id")) and not _may_grow(scan.join(scan.select("id"), "id"))
    assert _may_grow(scan.selectExpr("explode(many) AS id"))


def test_ingest_joins_without_a_shuffle(spark, root):
    from tidemark.operators.changes import reverse_delta

    store = HistoryStore(spark, root, buckets=4)
    for n in (1, 2):
        store.ingest(day(n), frame(spark, [address(i) for i in range(n, 20)]))
    for n in (1, 2):
        files = glob.glob(f"{root}/snapshot/day={day(n)}/__attempt=*/*.parquet")
        assert 0 < len(files) <= 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    delta = reverse_delta(store.snapshot(day(1)), store.snapshot(day(2)), store.keys)
    plan = delta._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 1 and "Exchange" not in plan


def test_dirty_dump(spark, root):
    store = HistoryStore(spark, root)
    good = address(1)
    dirty = [
        good,
        address(2, cle_interop=None),
        address(3, cle_interop="01001@3"),
        address(4, cle_interop="k" * 50),
        address(5, cle_interop="k" * 49),
        address(6, cle_interop=good["cle_interop"], voie_nom="Zone"),
    ]
    store.ingest(day(1), frame(spark, dirty))
    kept = {r["cle_interop"]: r["voie_nom"] for r in store.snapshot().collect()}
    assert kept == {good["cle_interop"]: "Rue du Four", "k" * 49: "Rue du Four"}


def test_schema_evolution(spark, root):
    old = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    new = T.StructType([*old.fields, T.StructField("w", T.StringType())])
    first = spark.createDataFrame([("a", 1), ("b", 2)], old)
    HistoryStore(spark, root, old, ["k"]).ingest(day(1), first)
    store = HistoryStore(spark, root, new, ["k"])
    # A dump that lacks the new column changes nothing.
    store.ingest(day(2), first)
    assert store.log(day(1)).isEmpty()
    store.ingest(day(3), spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], new))
    assert [r["k"] for r in store.log(day(2)).collect()] == ["a"]
    assert same(store.as_of(day(1)), first.withColumn("w", F.lit(None).cast("string")))
    with pytest.raises(TypeError):
        store.ingest(day(4), first.withColumn("v", F.lit(1.0)))
    with pytest.raises(ValueError):
        store.ingest(day(4), first.withColumn("z", F.lit(1)))
    with pytest.raises(ValueError):
        store.ingest(day(4), first.drop("k"))
    store.ingest(day(4), first.withColumn("z", F.lit(1)), extra="drop")
    assert store.days()[-1] == day(4)


def test_composite_and_numeric_keys(spark, root):
    schema = "region int, id bigint, v string"
    rows = [spark.createDataFrame(r, schema) for r in ([(1, 1, "a"), (2, 1, "b")], [(1, 1, "a"), (1, 2, "c"), (2, 1, "d")])]
    store = HistoryStore(spark, root, rows[0].schema, ["region", "id"])
    store.backfill({day(1): rows[0], day(2): rows[1]})
    assert same(store.as_of(day(1)), rows[0]) and same(store.as_of(day(2)), rows[1])
    assert tuple(store.summaries().filter(F.col("day") == day(2)).first())[1:] == (1, 1, 0, 2)


def test_empty_store(spark, root):
    store = HistoryStore(spark, root)
    assert store.days() == [] and store.log().isEmpty() and store.summaries().isEmpty()
    for call in (store.snapshot, store.report, lambda: store.as_of(day(1))):
        with pytest.raises(LookupError):
            call()


def test_reserved_names(spark, root):
    with pytest.raises(ValueError):
        HistoryStore(spark, root, T.StructType([*ADDRESS_SCHEMA.fields, T.StructField("day", T.DateType())]))


def test_rebuilt_days_can_be_compared(spark, root):
    """Unions on both sides of a comparison, over exchanges Spark may reuse."""
    days = history_days()
    store = HistoryStore(spark, root)
    store.backfill({d: frame(spark, rows) for d, rows in days.items()})
    for unique in (True, False):
        found = compare(store.as_of(day(1)), store.as_of(day(4)), store.keys, unique_keys=unique)
        got = sorted((r["cle_interop"], r["change"]) for r in found.collect())
        assert got == [
            ("01001_s1_00001", "modified"),
            ("01001_s1_00002", "removed"),
            ("01001_s1_00003", "added"),
        ]


def test_rebuild_does_not_shuffle_the_snapshot(spark, root):
    store = HistoryStore(spark, root, buckets=4)
    for n in (1, 2, 3):
        store.ingest(day(n), frame(spark, [address(i, numero=n) for i in range(20)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = store.as_of(day(2))
        plan = state._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        join = max(i for i in range(scan) if "SortMergeJoin" in lines[i])
        assert not any("Exchange" in line for line in lines[join:scan])
        assert same(state, frame(spark, [address(i, numero=2) for i in range(20)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_day_may_be_redone(spark, root):
    store = HistoryStore(spark, root)
    store.ingest(day(1), frame(spark, [address(1), address(2)]))
    store.ingest(day(1), frame(spark, [address(3)]))
    assert same(store.as_of(day(1)), frame(spark, [address(3)]))
    assert [r["action"] for r in store.log().collect()] == ["DELETE"]
    assert tuple(store.summaries().first())[1:] == (1, 0, 0, 1)


def test_a_refused_redo_leaves_the_day(spark, root):
    store = HistoryStore(spark, root)
    for n in (1, 2):
        store.ingest(day(n), frame(spark, [address(n)]))
    before = bag(store.log()), bag(store.snapshot())
    with pytest.raises(ValueError):
        store.ingest(day(2), frame(spark, [address(3)]).withColumn("more", F.lit(1)))
    assert store.days() == [day(1), day(2)]
    assert (bag(store.log()), bag(store.snapshot())) == before


def test_a_day_may_be_corrected_from_the_store_itself(spark, root):
    store = HistoryStore(spark, root)
    store.ingest(day(1), frame(spark, [address(1), address(2)]))
    store.ingest(day(2), frame(spark, [address(1), address(2), address(3)]))
    store.ingest(day(2), store.snapshot().filter("numero <> 2"))
    assert same(store.snapshot(), frame(spark, [address(1), address(3)]))
    assert same(store.as_of(day(1)), frame(spark, [address(1), address(2)]))
    assert same(store.log(day(1)).select("numero", "action"), spark.createDataFrame([(2, "INSERT"), (3, "DELETE")], "numero int, action string"))


def test_readers_keep_their_frames(spark, root):
    store = HistoryStore(spark, root)
    for n in (1, 2, 3):
        store.ingest(day(n), frame(spark, [address(n)]))
    opened = [store.snapshot(), store.snapshot(day(2)), store.as_of(day(1)), store.log()]
    expected = [bag(f) for f in opened]
    store.ingest(day(3), frame(spark, [address(7)]))
    store.ingest(day(4), frame(spark, [address(8)]))
    store.ingest(day(5), frame(spark, [address(9)]))
    assert [bag(f) for f in opened] == expected
    store.vacuum()
    assert same(store.as_of(day(3)), frame(spark, [address(7)]))
    assert len(os.listdir(f"{root}/diff/day={day(3)}")) == 1
    with pytest.raises(ValueError):
        store.vacuum(keep=1)


@pytest.mark.parametrize("step", ["_write_snapshot", "_read_snapshot", "_refused", "_write_summary"])
def test_a_crash_at_any_step_changes_nothing(spark, root, monkeypatch, step):
    store = HistoryStore(spark, root)
    store.ingest(day(1), frame(spark, [address(1)]))
    store.ingest(day(2), frame(spark, [address(2)]))
    before = bag(store.log()), bag(store.snapshot()), bag(store.summaries())

    def crash(*_, **__):
        raise RuntimeError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(HistoryStore, step, crash)
        with pytest.raises(RuntimeError):
            store.ingest(day(2), frame(spark, [address(5)]))
    assert (bag(store.log()), bag(store.snapshot()), bag(store.summaries())) == before
    store.ingest(day(2), frame(spark, [address(5)]))
    store.vacuum()
    assert same(store.snapshot(), frame(spark, [address(5)]))
    assert same(store.as_of(day(1)), frame(spark, [address(1)]))


def test_refusals_are_counted(spark, root, tmp_path):
    good = address(1)
    dirty = [
        good,
        address(2, cle_interop=None),
        address(3, cle_interop="01001@3"),
        address(4, cle_interop="k" * 50),
        address(6, cle_interop=good["cle_interop"], voie_nom="Zone"),
        ";".join(["x"] * 3),
    ]
    store = HistoryStore(spark, root)
    integrate(store, day(1), write_csv(tmp_path / "d.csv", dirty))
    got = {(r["day"], r["rule"]): r["refused"] for r in store.refusals().collect()}
    rules = ("cle_interop_missing", "cle_interop_shifted", "cle_interop_too_long", "duplicate", "malformed")
    assert got == {(day(1), rule): 1 for rule in rules}
    assert store.snapshot().count() == 1


def test_backfill_long_counts_refusals_per_day(spark, root):
    rows = [address(1), address(1, voie_nom="Zone"), address(2, cle_interop=None)]
    long = frame(spark, rows).withColumn("day", F.lit(day(1))).unionByName(
        frame(spark, rows[:1]).withColumn("day", F.lit(day(3))))
    store = HistoryStore(spark, root)
    store.backfill_long(long, days=[day(1), day(2), day(3)])
    got = {(r["day"], r["rule"]): r["refused"] for r in store.refusals().collect()}
    assert got == {(day(1), "duplicate"): 1, (day(1), "cle_interop_missing"): 1}
    assert store.as_of(day(2)).isEmpty()


def test_backfill_long_refuses_rows_without_a_day(spark, root):
    long = frame(spark, [address(1)]).withColumn("day", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="has no day"):
        HistoryStore(spark, root).backfill_long(long)
    assert HistoryStore(spark, root).days() == []
