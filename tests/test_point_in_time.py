"""Joins with the version that held at a fact's own time."""

import datetime as dt
import random
import sys

import pytest

from tidemark import HistoryStore, point_in_time, versions

from .helpers import day, same

FACTS = "id int, k string, at timestamp_ntz"
VERSIONS = "k string, since timestamp_ntz, v int, here boolean"


def time(n):
    return None if n is None else dt.datetime(2025, 1, 1) + dt.timedelta(minutes=n)


def tables(spark, seed, n_facts=300, n_versions=120, keys=4, span=60, missing=0.05):
    """Few keys and few times: ties all over, null keys and times on both sides."""
    draw = random.Random(seed)

    def maybe(value):
        return None if draw.random() < missing else value

    facts = [(i, maybe(f"k{draw.randrange(keys)}"), maybe(draw.randrange(span))) for i in range(n_facts)]
    facts += facts[:20]
    held = {}
    for i in range(n_versions):
        held[maybe(f"k{draw.randrange(keys + 1)}"), maybe(draw.randrange(span))] = (i, draw.random() < 0.8)
    return facts, [(k, at, v, here) for (k, at), (v, here) in held.items()]


def brute(facts, known):
    out = []
    for i, k, at in facts:
        best = None
        for key, since, v, here in known:
            if k is not None and at is not None and key == k and (since is None or since <= at):
                order = -1 if since is None else since
                if best is None or order > best[0]:
                    best = (order, v, here)
        found = bool(best and best[2])
        out.append((i, k, time(at), best[1] if found else None, found))
    return sorted(out, key=repr)


def joined(spark, facts, known, **options):
    f = spark.createDataFrame([(i, k, time(at)) for i, k, at in facts], FACTS)
    v = spark.createDataFrame([(k, time(s), n, here) for k, s, n, here in known], VERSIONS)
    rows = point_in_time(f, v, ["k"], "at", present="here", **options).collect()
    return sorted(((r["id"], r["k"], r["at"], r["v"], r["found"]) for r in rows), key=repr)


@pytest.mark.parametrize("options", [{}, {"most": 20, "ranges": 2}, {"most": 5, "ranges": 7}, {"most": 0, "ranges": 40}])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed, options):
    facts, known = tables(spark, seed)
    assert joined(spark, facts, known, **options) == brute(facts, known)


def test_many_facts_at_one_time(spark):
    facts = [(i, "k0", 7 if i % 5 else i % 9) for i in range(400)]
    known = [("k0", s, s, s != 5) for s in (2, 5, 7, 8)]
    assert joined(spark, facts, known, most=10, ranges=20) == brute(facts, known)


def test_a_hot_key_is_cut(spark):
    facts = spark.createDataFrame([(i, "hot", time(i % 500)) for i in range(4000)], FACTS)
    known = spark.createDataFrame([("hot", time(s), s, True) for s in range(0, 500, 50)], VERSIONS)
    # The package exports the function under the module's name.
    module = sys.modules["tidemark.operators.point_in_time"]
    asked = facts.selectExpr("k", "at AS __at", "struct(id) AS __fact")
    given = known.selectExpr("k", "since AS __at", "struct(here AS __present, struct(v) AS __row) AS __version")
    hot = module._hot_keys(asked, given, ["k"], 100, 10)
    sizes = module._ranged(asked, hot, ["k"], spread=True).groupBy("__range").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 600
    assert module._hot_keys(asked, given, ["k"], 10_000, 10).isEmpty()


def test_no_facts_and_no_versions(spark):
    facts, known = tables(spark, 4, 30, 10)
    assert joined(spark, facts, known[:1] * 0 or [("zz", 1, 1, True)]) == brute(facts, [])
    assert joined(spark, [(1, None, None)], known) == [(1, None, None, None, False)]


def test_names_and_types_are_checked(spark):
    facts = spark.createDataFrame([(1, "a", time(1))], FACTS)
    known = spark.createDataFrame([("a", time(1), 1, True)], VERSIONS)
    with pytest.raises(ValueError):
        point_in_time(facts.withColumnRenamed("id", "v"), known, ["k"], "at", present="here")
    with pytest.raises(TypeError):
        point_in_time(facts, known.selectExpr("k", "v", "CAST(since AS DATE) AS since"), ["k"], "at")
    with pytest.raises(ValueError):
        point_in_time(facts, known, ["k"], "at", ranges=1)


def test_versions_of_a_store_give_every_day(spark, root):
    states = [
        {"a": 1, "b": 1}, {"a": 2, "b": 1}, {"b": 1, "c": None}, {}, {"a": 2}, {"a": 2, "b": 5}, {"a": 3, "b": 5},
    ]
    schema = "k string, v int"
    store = HistoryStore(spark, root, spark.createDataFrame([], schema).schema, ["k"])
    store.backfill({day(i + 1): spark.createDataFrame(list(s.items()), schema) for i, s in enumerate(states)})
    known = store.versions()
    facts = spark.createDataFrame(
        [(k, dt.date(2024, 12, 31) + dt.timedelta(n)) for n in range(9) for k in "abcd"], "k string, at date"
    )
    rows = point_in_time(facts, known, ["k"], "at", present="present").collect()
    got = {(r["k"], r["at"]): (r["v"], r["found"]) for r in rows}
    for n in range(9):
        state = {} if n == 0 else states[min(n, 7) - 1]
        for k in "abcd":
            assert got[k, dt.date(2024, 12, 31) + dt.timedelta(n)] == (state.get(k), k in state), (k, n)
    # Each version is there once, and says where a key was absent.
    held = [(r["k"], r["since"], r["v"], r["present"]) for r in known.collect()]
    assert len(held) == len(set(held))
    assert ("c", day(4), None, False) in held and ("b", day(6), 5, True) in held


def test_versions_without_a_log(spark):
    schema = "k string, v int"
    snapshot = spark.createDataFrame([("a", 1)], schema)
    log = spark.createDataFrame([], f"{schema}, action string, day date")
    expected = spark.createDataFrame([("a", 1, None, True)], f"{schema}, since date, present boolean")
    assert same(versions(snapshot, log, ["k"]), expected)
