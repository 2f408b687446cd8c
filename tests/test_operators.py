"""Operators on small hand-made rows: nulls, repeats, skew, order, names."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.functions import any_of, passes
from tidemark.operators.history import calendar

from .helpers import bag, day, same

ROWS = "k string, a string, b string, n int"


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def kinds(changes, *columns):
    return Counter(tuple(r[c] for c in ("k", "change", *columns)) for r in changes.collect())


# compare


@pytest.mark.parametrize("unique", [True, False])
def test_compare_classifies(spark, unique):
    before = frame(spark, [("same", "x", None, 1), ("gone", "x", "y", 1), ("mod", "x", "y", 1)])
    after = frame(spark, [("same", "x", None, 1), ("new", "x", "y", 1), ("mod", "x", "z", 1)])
    changes = tm.compare(before, after, ["k"], unique_keys=unique)
    assert changes.columns == ["k", "change", "old_a", "old_b", "old_n", "new_a", "new_b", "new_n"]
    assert kinds(changes, "old_b", "new_b") == {
        ("gone", "removed", "y", None): 1,
        ("new", "added", None, "y"): 1,
        ("mod", "modified", "y", "z"): 1,
    }
    assert tuple(tm.change_summary(changes).first()) == (1, 1, 1, 3)


@pytest.mark.parametrize("unique", [True, False])
def test_compare_nulls_in_values(spark, unique):
    before = frame(spark, [("1", None, "v", 1), ("2", "v", None, 1), ("3", None, None, None)])
    after = frame(spark, [("1", "v", None, 1), ("2", None, None, 1), ("3", None, None, None)])
    changes = tm.compare(before, after, ["k"], unique_keys=unique)
    # A value that moves between two null columns has the same joined fingerprint.
    assert kinds(changes) == {("1", "modified"): 1, ("2", "modified"): 1}


@pytest.mark.parametrize("unique", [True, False])
def test_compare_null_keys_equal_nothing(spark, unique):
    before = frame(spark, [(None, "x", "y", 1), ("k", "x", "y", 1)])
    after = frame(spark, [(None, "x", "y", 1), ("k", "x", "y", 1)])
    changes = tm.compare(before, after, ["k"], unique_keys=unique)
    assert kinds(changes, "old_a", "new_a") == {
        (None, "removed", "x", None): 1,
        (None, "added", None, "x"): 1,
    }


def test_compare_composite_keys_with_a_null_part(spark):
    before = frame(spark, [("k", None, "old", 1), ("k", "p", "old", 1)])
    after = frame(spark, [("k", None, "old", 1), ("k", "p", "new", 1)])
    changes = tm.compare(before, after, ["k", "a"])
    assert kinds(changes, "a") == {
        ("k", "removed", None): 1,
        ("k", "added", None): 1,
        ("k", "modified", "p"): 1,
    }


def test_compare_repeated_keys_whole_rows(spark):
    before = frame(spark, [("d", "x", "1", 1)] * 2 + [("d", "y", "1", 1), ("u", "x", "1", 1)])
    after = frame(spark, [("d", "x", "1", 1), ("d", "z", "1", 1), ("u", "y", "1", 1)])
    changes = tm.compare(before, after, ["k"])
    assert kinds(changes, "old_a", "new_a") == {
        ("d", "removed", "x", None): 1,
        ("d", "removed", "y", None): 1,
        ("d", "added", None, "z"): 1,
        ("u", "modified", "x", "y"): 1,
    }
    # One old row of the key is left and one new one: it was modified.
    before = before.filter("a <> 'x' OR k = 'u'").union(frame(spark, [("d", "x", "1", 1)]))
    assert kinds(tm.compare(before, after, ["k"]), "old_a", "new_a") == {
        ("d", "modified", "y", "z"): 1,
        ("u", "modified", "x", "y"): 1,
    }


def test_compare_hot_key_does_not_pair(spark):
    """One key on a third of both sides: pairing it would give 10^8 rows."""
    size = 30_000
    rows = spark.range(size).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) AS k", "string(id) AS a", "'b' AS b", "0 AS n"
    )
    changed = rows.withColumn("a", F.expr("if(a = '3', 'other', a)"))
    changes = tm.compare(rows, changed, ["k"])
    assert kinds(changes, "old_a", "new_a") == {("hot", "modified", "3", "other"): 1}
    # All of its rows change: they come out one by one.
    changed = rows.withColumn("b", F.expr("if(k = 'hot', 'c', b)"))
    assert tuple(tm.change_summary(tm.compare(rows, changed, ["k"])).first()) == (10000, 0, 10000, 20000)


def test_compare_keeps_the_number_of_copies(spark):
    before = spark.range(25_000).selectExpr("'k' AS k", "1 AS v")
    after = spark.range(3).selectExpr("'k' AS k", "1 AS v")
    assert tuple(tm.change_summary(tm.compare(before, after, ["k"])).first()) == (0, 0, 24_997, 24_997)
    assert tuple(tm.change_summary(tm.compare(after, before, ["k"])).first()) == (24_997, 0, 0, 24_997)


def test_compare_ignores_and_reports_columns(spark):
    before = frame(spark, [("k", "x", "y", 1)]).withColumn("hash", F.lit("h1"))
    after = frame(spark, [("k", "x", "y", 1)]).withColumn("hash", F.lit("h2")).withColumn("z", F.lit(1))
    assert tm.compare(before, after.drop("b"), ["k"]).isEmpty()
    assert not tm.compare(before, after, ["k"], ignore=()).isEmpty()
    got = {tuple(r) for r in tm.column_differences(before.drop("b"), after).collect()}
    assert got == {("b", None, "string"), ("z", None, "int")}


def test_compare_refuses_clashing_names(spark):
    df = frame(spark, [("k", "x", "y", 1)]).withColumnRenamed("k", "old_a")
    with pytest.raises(ValueError):
        tm.compare(df, df, ["old_a"])


def test_compare_odd_column_names_and_keys_only(spark):
    before = spark.createDataFrame([("k", 1)], "`the key` string, `a.b` int")
    after = spark.createDataFrame([("k", 2)], "`the key` string, `a.b` int")
    changes = tm.compare(before, after, ["the key"])
    assert changes.first()["old_a.b"] == 1
    assert tm.modified_rows(changes, ["the key"], ["a.b"]).columns == ["the key", "old_a.b", "new_a.b"]
    keys = before.select("`the key`")
    assert tm.compare(keys, keys, ["the key"]).isEmpty()


def test_wide_comparison_stays_shallow():
    text = any_of([f"c{i}" for i in range(1000)])
    depth = deepest = 0
    for ch in text:
        depth += {"(": 1, ")": -1}.get(ch, 0)
        deepest = max(deepest, depth)
    assert deepest <= 10 and text.count(" OR ") == 999 and any_of([]) == "false"


def test_compare_five_hundred_columns(spark):
    wide = spark.range(5).selectExpr("id", *[f"id + {i} AS c{i}" for i in range(500)])
    other = wide.withColumn("c499", F.expr("if(id = 3, -1, c499)"))
    assert tm.compare(wide, other, ["id"], unique_keys=True).select("id").collect()[0][0] == 3


def test_projections_and_sample(spark):
    before = frame(spark, [("a", "x", "y", 1), ("b", "x", "y", 2), ("m", "p", "q", 3)])
    after = frame(spark, [("c", "x", "y", 4), ("m", "r", "q", 3)])
    changes = tm.compare(before, after, ["k"])
    assert same(tm.removed_rows(changes, ["k"]), before.filter("k < 'm'"))
    assert same(tm.added_rows(changes, ["k"], ["n"]), after.filter("k = 'c'").select("k", "n"))
    got = tm.modified_rows(changes, ["k"], {"first": "a", "second": "b"}).first().asDict()
    assert got == {"k": "m", "old_first": "p", "new_first": "r", "old_second": "q", "new_second": "q"}
    assert [r["k"] for r in tm.change_sample(before, ["k"], 2).collect()] == ["a", "b"]


def test_floats_compare_as_spark_does(spark):
    nan = float("nan")
    a = spark.createDataFrame([("1", nan), ("2", 0.0), ("3", 1.0)], "k string, v double")
    b = spark.createDataFrame([("1", nan), ("2", -0.0), ("3", None)], "k string, v double")
    assert kinds(tm.compare(a, b, ["k"])) == {("3", "modified"): 1}


# clean


def test_dedupe_is_independent_of_layout(spark):
    rows = [("k", None, "z", 3), ("k", "b", "a", 1), ("k", "a", None, 2), ("k", "a", "c", 9), ("j", "q", "q", 0)]
    results = {
        tuple(map(tuple, tm.dedupe(frame(spark, order).repartition(n), ["k"]).orderBy("k").collect()))
        for order in (rows, rows[::-1])
        for n in (1, 3, 7)
    }
    assert results == {(("j", "q", "q", 0), ("k", "a", "c", 9))}
    first = tm.dedupe(frame(spark, rows), ["k"], prefer=["n DESC"]).filter("k = 'k'").first()
    assert first["n"] == 9


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    plan = tm.dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert sorted(r["v"] for r in tm.dedupe(df, ["k"]).collect()) == list(range(10))


def test_rules_and_rejections(spark):
    df = frame(spark, [(None, "", "", 1), ("x@y", "", "", 1), ("k" * 50, "", "", 1), ("@" * 60, "", "", 1), ("k" * 49, "", "", 1), ("", "", "", 1)])
    rules = tm.key_rules(df.schema, ["k"])
    assert {r["k"] for r in df.filter(passes(rules)).collect()} == {"k" * 49, ""}
    got = {r["rule"]: r["rejected"] for r in tm.rejections(df, rules).collect()}
    assert got == {"k_missing": 1, "k_shifted": 2, "k_too_long": 1}
    own = [tm.Rule("odd 'n'", "n % 2 = 1")]
    assert tm.rejections(df, own).isEmpty()
    assert tm.rejections(df, []).isEmpty()
    assert [r.name for r in tm.key_rules(df.schema, ["n"])] == ["n_missing"]


def test_row_hashes(spark):
    df = frame(spark, [("a", None, "b", 1), (None, "a", "b", 1)])
    joined = df.select(tm.row_hash(["k", "a", "b"]).alias("h")).distinct().count()
    named = df.select(tm.row_hash_named(["k", "a", "b"]).alias("h")).distinct().count()
    assert (joined, named) == (1, 2)


# history


def dumps(spark, rows):
    return spark.createDataFrame(rows, "day date, k string, v int")


def test_calendar(spark):
    df = dumps(spark, [(day(1), "a", 1), (day(1), "b", 1), (day(4), "a", 1), (day(2), "a", 1)])
    expected = {(day(1), None, day(2)), (day(2), day(1), day(4)), (day(4), day(2), None)}
    assert {tuple(r) for r in calendar(df).collect()} == expected
    assert {tuple(r) for r in calendar(df, [day(4), "2025-01-01", day(2)]).collect()} == expected
    assert {tuple(r) for r in calendar(df.limit(0), df.select("day")).collect()} == expected


def test_reverse_log_rules(spark):
    df = dumps(spark, [
        (day(1), "stay", 1), (day(2), "stay", 1), (day(5), "stay", 1),
        (day(1), "mod", 1), (day(2), "mod", None), (day(5), "mod", None),
        (day(1), "gone", 7), (day(1), "back", 1), (day(5), "back", 1), (day(2), "late", 3),
    ])
    got = {tuple(r) for r in tm.reverse_log(df, ["k"]).select("day", "action", "k", "v").collect()}
    assert got == {
        (day(1), "DELETE", "stay", 1), (day(1), "DELETE", "mod", 1),
        (day(1), "DELETE", "gone", 7), (day(1), "DELETE", "back", 1),
        (day(2), "UPDATE", "mod", 1), (day(2), "INSERT", "gone", 7), (day(2), "INSERT", "back", 1),
        (day(2), "DELETE", "late", 3),
        (day(5), "DELETE", "back", 1), (day(5), "INSERT", "late", 3),
    }


def test_reverse_log_knows_empty_dumps(spark):
    df = dumps(spark, [(day(1), "a", 1), (day(3), "a", 1)])
    days = [day(1), day(2), day(3), day(4)]
    got = {tuple(r) for r in tm.reverse_log(df, ["k"], days).select("day", "action", "k", "v").collect()}
    assert got == {
        (day(1), "DELETE", "a", 1), (day(2), "INSERT", "a", 1),
        (day(3), "DELETE", "a", 1), (day(4), "INSERT", "a", 1),
    }


def test_reverse_log_of_keys_only(spark):
    df = dumps(spark, [(day(1), "a", 1), (day(2), "a", 1), (day(2), "b", 1)]).drop("v")
    log = tm.reverse_log(df, ["k"])
    assert {tuple(r) for r in log.collect()} == {("a", "DELETE", day(1)), ("b", "DELETE", day(2))}


def test_reverse_log_shuffles_once(spark):
    df = dumps(spark, [(day(1), "a", 1)])
    plan = tm.reverse_log(df, ["k"], [day(1)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_log_order_of_columns_is_kept(spark):
    """An UPDATE keeps every value in its own column, wherever the key stands."""
    before = spark.createDataFrame([("u1", "k1", "old")], "uid string, k string, v string")
    after = spark.createDataFrame([("u1", "k1", "new")], "uid string, k string, v string")
    delta = tm.reverse_delta(before, after, ["k"])
    assert delta.columns == ["uid", "k", "v", "action"]
    assert tuple(delta.first()) == ("u1", "k1", "old", "UPDATE")


def test_as_of_prunes_and_leaves_the_snapshot_in_place(spark, tmp_path):
    df = dumps(spark, [(day(n), f"k{i}", n) for n in range(1, 5) for i in range(3)])
    tm.reverse_log(df, ["k"]).write.partitionBy("day").parquet(str(tmp_path / "log"))
    snapshot = df.filter(f"day = DATE'{day(4)}'").drop("day")
    log = spark.read.parquet(str(tmp_path / "log"))
    state = tm.as_of(snapshot, log, day(2), ["k"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert {tuple(r) for r in state.collect()} == {(f"k{i}", 2) for i in range(3)}


def test_bad_days_are_refused(spark):
    df = dumps(spark, [(day(1), "a", 1)])
    log = tm.reverse_log(df, ["k"])
    with pytest.raises(ValueError):
        tm.as_of(df.drop("day"), log, "not a day", ["k"])
    with pytest.raises(TypeError):
        tm.as_of(df.drop("day"), log, dt.datetime(2025, 1, 1), ["k"])
    with pytest.raises(ValueError):
        tm.as_of_many(df.drop("day"), log, [], ["k"])


# metrics


def places(spark):
    rows = [("1", "01001", "a"), ("2", "01002", None), ("3", None, "a"), ("4", "2A001", "b"),
            ("5", "97105", "b"), ("6", "97205", "b"), (None, "01001", "c")]
    return spark.createDataFrame(rows, "cle_interop string, commune_insee string, voie_nom string")


def test_report_counts_a_null_as_a_value(spark):
    assert tuple(tm.snapshot_report(places(spark)).first()) == (7, 6, 4, 4)


@pytest.mark.parametrize("unique", [True, False])
def test_metrics_leave_nulls_out(spark, unique):
    got = tm.snapshot_metrics(places(spark), ["cle_interop"], unique_keys=unique)
    assert tuple(got.first()) == (6, 5, 3, 3)


@pytest.mark.parametrize("unique", [True, False])
def test_metrics_of_nothing(spark, unique):
    none = places(spark).filter("false")
    assert tuple(tm.snapshot_report(none).first()) == (0, 0, 0, 0)
    assert tuple(tm.snapshot_metrics(none, ["cle_interop"], unique_keys=unique).first()) == (0, 0, 0, 0)


def test_metrics_count_repeated_keys_once(spark):
    twice = places(spark).union(places(spark))
    assert tm.snapshot_metrics(twice, ["cle_interop"]).first()["addresses"] == 6


def test_metrics_of_integer_codes_and_composite_keys(spark):
    df = spark.createDataFrame([(1, 1001, "s"), (1, 1002, "s"), (None, 75001, "s")], "k int, c int, s string")
    assert tuple(tm.snapshot_metrics(df, ["k", "c"], "c", "s").first()) == (2, 3, 1, 2)
    assert tuple(tm.snapshot_metrics(df, ["k", "c"], "c", "s", unique_keys=True).first()) == (2, 3, 1, 2)


def test_rows_per_prefix(spark):
    got = [tuple(r) for r in tm.rows_per_prefix(places(spark)).collect()]
    assert got == [(None, 1), ("01", 3), ("2A", 1), ("97", 2)]


def test_compare_and_reconcile_metrics(spark):
    a, b = places(spark), places(spark).filter("cle_interop <> '4'")
    got = {r["metric"]: (r["before"], r["after"]) for r in tm.compare_metrics(a, b, ["cle_interop"]).collect()}
    assert got == {"addresses": (6, 5), "communes": (5, 4), "streets": (3, 2), "departments": (3, 2)}
    agrees = {r["metric"]: r["agrees"] for r in tm.reconcile_metrics(a, a, ["cle_interop"]).collect()}
    assert set(agrees.values()) == {True}
    assert bag(tm.extra_keys(a.union(a), b, ["cle_interop"])) == {("'4'",): 1, ("None",): 1}
    assert tm.missing_keys(a, b, ["cle_interop"]).isEmpty()


def test_approximate_metrics(spark):
    df = spark.range(20000).selectExpr("id AS k", "string(id % 500) AS c", "string(id % 3000) AS s")
    exact = tm.snapshot_metrics(df, ["k"], "c", "s").first()
    close = tm.approximate_metrics(df, ["k"], "c", "s").first()
    assert all(abs(x - y) <= 0.1 * x for x, y in zip(exact, close))


def test_column_names_the_operators_use_themselves(spark):
    rows = spark.createDataFrame([(day(n), 1, n, "a", "b", "c") for n in (1, 2)], "day date, next int, row int, previous string, commune string, street string")
    log = tm.reverse_log(rows, ["next"])
    assert log.columns == ["next", "row", "previous", "commune", "street", "action", "day"]
    assert sorted(r["action"] for r in log.collect()) == ["DELETE", "UPDATE"]
    last = rows.filter("row = 2").drop("day")
    assert tm.as_of(last, log, day(1), ["next"]).first()["row"] == 1
    assert tm.as_of_many(last, log, [day(1), day(2)], ["next"]).count() == 2
    assert tm.compare(rows, last, ["next"]).count() == 1
    for unique in (True, False):
        got = tm.snapshot_metrics(last, ["commune"], "previous", "street", unique_keys=unique)
        assert tuple(got.first()) == (1, 1, 1, 1)


def test_reverse_log_refuses_days_that_are_not_listed(spark):
    rows = spark.createDataFrame([(dt.date(2025, 1, 1), "a", 1), (dt.date(2025, 1, 2), "b", 2)], "day date, k string, v int")
    with pytest.raises(Exception, match="no dump is listed for day 2025-01-02"):
        tm.reverse_log(rows, ["k"], ["2025-01-01"]).collect()
    missing = rows.withColumn("day", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="day null"):
        tm.reverse_log(missing.unionByName(rows), ["k"]).collect()


def test_compare_splits_a_hot_key(spark):
    """The rows of a hot key meet it over a salt, and single copies are not shuffled again."""
    a, b = (spark.range(400).selectExpr("1 AS k", f"id * {s} AS v") for s in (2, 2_000))
    changes = tm.compare(a, b, ["k"])
    got = changes.groupBy("change").count().collect()
    both = {2 * i for i in range(400)} & {2000 * i for i in range(400)}
    assert {r["change"]: r["count"] for r in got} == {"removed": 400 - len(both), "added": 400 - len(both)}
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan and "__copy" in plan


def test_as_of_many_spans(spark):
    """Every bound before, inside and behind the wanted days, with gaps between these."""
    start = dt.date(2025, 1, 1)
    every = [start + dt.timedelta(n) for n in range(12)]
    for wanted in (every[3:4], every[2:9:3], every[4:6] + every[9:10]):
        log = spark.createDataFrame(
            [("a", 1, "UPDATE", every[3]), ("a", 2, "UPDATE", every[5]), ("b", 1, "DELETE", every[4]), ("c", 1, "INSERT", every[8])],
            "k string, v int, action string, day date",
        )
        snapshot = spark.createDataFrame([("a", 3), ("b", 9)], "k string, v int")
        got = bag(tm.as_of_many(snapshot, log, wanted, ["k"]))
        expected = Counter()
        for d in wanted:
            one = tm.as_of(snapshot, log, d, ["k"]).withColumn("as_of", F.lit(d))
            expected += bag(one)
        assert got == expected
