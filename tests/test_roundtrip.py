"""Random histories: every day must come back from the log."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidemark as tm

from .helpers import bag, same

START = dt.date(2025, 3, 1)
SCHEMA = "k string, a string, b string, n int"

values = st.tuples(
    st.sampled_from([None, "x", "y"]), st.sampled_from([None, "x", "y"]), st.sampled_from([None, 0, 1])
)
dump = st.dictionaries(st.sampled_from("pqrstu"), values, max_size=6)
histories = st.lists(st.tuples(st.integers(1, 3), dump), min_size=1, max_size=5)


def as_days(history):
    day, days = START, {}
    for gap, rows in history:
        day += dt.timedelta(gap)
        days[day] = [(k, *v) for k, v in rows.items()]
    return days


def brute_log(days):
    """The log by the rule itself, key by key."""
    log, before = [], {}
    for day, rows in days.items():
        today = {r[0]: r for r in rows}
        for k in {*today, *before}:
            if k not in before:
                log.append((*today[k], "DELETE", day))
            elif k not in today:
                log.append((*before[k], "INSERT", day))
            elif today[k] != before[k]:
                log.append((*before[k], "UPDATE", day))
        before = today
    return log


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories)
def test_every_day_comes_back(spark, history):
    days = as_days(history)
    long = spark.createDataFrame([(d, *r) for d, rows in days.items() for r in rows], f"day date, {SCHEMA}")
    log = tm.reverse_log(long, ["k"], list(days)).cache()
    expected = spark.createDataFrame(brute_log(days), f"{SCHEMA}, action string, day date")
    assert bag(log.select(*expected.columns)) == bag(expected)

    last = list(days)[-1]
    snapshot = spark.createDataFrame(days[last], SCHEMA)
    first = START + dt.timedelta(1)
    every = [first + dt.timedelta(n) for n in range((last - first).days + 2)]
    wanted = []
    for d in every:
        past = [x for x in days if x <= d]
        wanted += [(d, *r) for r in (days[past[-1]] if past else [])]
    expected = spark.createDataFrame(wanted, f"as_of date, {SCHEMA}")
    assert same(tm.as_of_many(snapshot, log, every, ["k"]), expected)
    middle = every[len(every) // 2]
    assert same(
        tm.as_of(snapshot, log, middle, ["k"]),
        expected.filter(F.col("as_of") == F.lit(middle)).drop("as_of"),
    )
    log.unpersist()


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from([None, "p", "q", "r"]), values), max_size=8),
    st.lists(st.tuples(st.sampled_from([None, "p", "q", "r"]), values), max_size=8),
)
def test_compare_accounts_for_every_row(spark, left, right):
    """With repeats and null keys: undoing the changes leads back, as multisets."""
    a = spark.createDataFrame([(k, *v) for k, v in left], SCHEMA)
    b = spark.createDataFrame([(k, *v) for k, v in right], SCHEMA)
    changes = tm.compare(a, b, ["k"]).collect()

    def rows(kinds, side):
        return [tuple(repr(r[c]) for c in ("k", f"{side}_a", f"{side}_b", f"{side}_n")) for r in changes if r["change"] in kinds]

    def counted(df):
        return bag(df.select("a", "b", "k", "n"))

    undone = counted(b)
    undone.subtract((x[1], x[2], x[0], x[3]) for x in rows({"added", "modified"}, "new"))
    undone.update((x[1], x[2], x[0], x[3]) for x in rows({"removed", "modified"}, "old"))
    assert +undone == +counted(a) and min(undone.values(), default=0) >= 0
    # A modified key has no other change.
    per_key = Counter(r["k"] for r in changes)
    assert all(per_key[r["k"]] == 1 for r in changes if r["change"] == "modified")
