"""Extra and missing keys out of small tables, and key by key where these do not suffice."""

import random

import pytest

from tidemark.operators.key_sketch import LONG, key_sketch, reconcile_keys, sketch_differences

SCHEMA = "k string, n long, v int"


def frame(spark, keys):
    return spark.createDataFrame([(k, n, 1) for k, n in keys], SCHEMA)


def expected(a, b):
    return sorted([(*k, "extra") for k in set(a) - set(b)] + [(*k, "missing") for k in set(b) - set(a)], key=repr)


def found(rows):
    return sorted(((r["k"], r["n"], r["side"]) for r in rows.collect()), key=repr)


def sides(seed, n, differ):
    draw = random.Random(seed)
    both = [(f"01001_é{i:06d}", i) for i in range(n)]
    odd = [(None, 5), ("", None), (None, None), ('quote"\\', -3), ("a\nb", 2**62), ("ünïcode 日本", 0)]
    a = both + draw.sample(odd, 3) + [(f"a{i}", draw.randrange(10**12)) for i in range(differ)]
    b = both + draw.sample(odd, 3) + [(f"b{i}", i) for i in range(differ)]
    return a, b


@pytest.mark.parametrize("differ", [0, 5, 40, 400])
def test_equals_except_both_ways(spark, differ):
    a, b = sides(differ, 500, differ)
    got = reconcile_keys(frame(spark, a), frame(spark, b), ["k", "n"], buckets=8, cells=48, unique_keys=True)
    assert found(got) == expected(a, b)


def test_few_differences_are_told_by_the_sketches_alone(spark):
    a, b = sides(1, 3000, 20)
    tables = [key_sketch(frame(spark, s), ["k", "n"], 16, 48, unique_keys=True).cache() for s in (a, b)]
    assert all(t.count() <= 16 * 48 for t in tables)
    told = sketch_differences(*tables, 48).collect()
    assert all(r["side"] for r in told) and len(told) == len(expected(a, b))
    # So the rows need not be there.
    nothing = frame(spark, a).limit(0)
    assert found(reconcile_keys(nothing, nothing, ["k", "n"], tables, 16, 48)) == expected(a, b)


def test_a_bucket_that_is_too_full_falls_back(spark):
    a, b = sides(2, 100, 300)
    tables = [key_sketch(frame(spark, s), ["k", "n"], 4, 30).cache() for s in (a, b)]
    told = sketch_differences(*tables, 30).collect()
    assert {(r["side"], r["text"]) for r in told} == {(None, None)} and len(told) == 4
    assert found(reconcile_keys(frame(spark, a), frame(spark, b), ["k", "n"], tables, 4, 30)) == expected(a, b)


def test_some_buckets_fall_back(spark):
    a, b = sides(3, 100, 60)
    tables = [key_sketch(frame(spark, s), ["k", "n"], 16, 15).cache() for s in (a, b)]
    told = sketch_differences(*tables, 15).collect()
    assert any(r["side"] is None for r in told) and any(r["side"] for r in told)
    assert found(reconcile_keys(frame(spark, a), frame(spark, b), ["k", "n"], tables, 16, 15)) == expected(a, b)


def test_long_keys_fall_back(spark):
    a = [("x" * 200, 1), ("short", 2), ("both " * 30, 3)]
    b = [("y" * 200, 1), ("both " * 30, 3), ("other", 4)]
    tables = [key_sketch(frame(spark, s), ["k", "n"], 2, 12) for s in (a, b)]
    assert tables[0].filter(f"cell = {LONG}").count() >= 1
    assert found(reconcile_keys(frame(spark, a), frame(spark, b), ["k", "n"], buckets=2, cells=12)) == expected(a, b)


def test_repeated_keys_count_once(spark):
    a, b = [("x", 1)] * 3 + [("y", 2)], [("x", 1), ("z", 3), ("z", 3)]
    assert found(reconcile_keys(frame(spark, a), frame(spark, b), ["k", "n"])) == expected(a, b)


def test_nothing_on_a_side(spark):
    a = [(f"k{i}", i) for i in range(30)]
    for x, y in ((a, []), ([], a), ([], [])):
        sides_of = [frame(spark, s) if s else frame(spark, a).limit(0) for s in (x, y)]
        assert found(reconcile_keys(*sides_of, ["k", "n"], buckets=4)) == expected(x, y)


def test_cells_must_be_dealt_evenly(spark):
    with pytest.raises(ValueError):
        key_sketch(frame(spark, [("a", 1)]), ["k"], cells=100)
