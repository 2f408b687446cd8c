"""Reverse logs and what can be rebuilt from them.

A reverse log holds, for each day, the rows needed to go back one day:
DELETE for a key that appeared, INSERT with the old row for one that vanished,
UPDATE with the old row for one that changed. On the first day every row is a
DELETE. All functions take snapshots with unique, non-null keys, as ``clean``
makes them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import differs, ident, idents
from ..functions.unions import union_all
from ..sources.schema import ACTION, DAY, as_day

# Fixed value: the end of what still holds.
FAR_FUTURE = dt.date(9999, 12, 31)


Days = DataFrame | Sequence[dt.date | str] | None


def calendar(dumps: DataFrame, days: Days = None) -> DataFrame:
    """The days that have a dump, each with the dump day before and after it.

    Columns: ``day``, ``previous``, ``next``. Without ``days`` they are the
    distinct days of ``dumps``; given a frame, those of its ``day`` column.
    They are gathered with partial aggregation, and there is one row per
    calendar date at most, whatever the data's size.
    """
    if days is None or isinstance(days, DataFrame):
        source = dumps if days is None else days
        listed = source.groupBy().agg(F.expr(f"sort_array(collect_set({DAY})) AS days"))
    else:
        known = sorted({as_day(d) for d in days})
        listed = dumps.sparkSession.createDataFrame([(known,)], "days array<date>")
    return listed.selectExpr(
        f"inline(transform(days, (d, i) -> named_struct('{DAY}', d,"
        " 'previous', if(i > 0, get(days, i - 1), NULL), 'next', get(days, i + 1))))"
    )


def reverse_log(dumps: DataFrame, keys: Sequence[str], days: Days = None) -> DataFrame:
    """The reverse log of many dumps in one job.

    ``dumps`` holds ``day``, the keys and the row, a key at most once a day
    (``dedupe(dumps, ["day", *keys])``). Pass ``days``, as a list or as a frame
    with a ``day`` column, when some dump is empty or when they come cheaper
    than from ``dumps``, which else is computed once more to list them. A row
    whose day is null or not among them fails the query.

    One shuffle on the keys brings each key's history together, a row per day
    at most; both what appeared and what vanished is then read off a row's
    neighbours. The calendar joins by broadcast: it has one row per date.
    """
    columns = [c for c in dumps.columns if c not in {DAY, *keys}]
    row = f"struct({', '.join(idents(columns) or ['1 AS __none'])})"
    listed = calendar(dumps, days).toDF("__listed", "__previous", "__next")
    refuse = f"raise_error(concat('no dump is listed for day ', coalesce(string({DAY}), 'null')))"
    seen = (
        dumps.join(F.broadcast(listed), F.col(DAY) == F.col("__listed"), "left")
        .selectExpr(
            *idents(keys),
            f"if(__listed IS NULL, {refuse}, {DAY}) AS {DAY}",
            "__previous",
            "__next",
            f"{row} AS __row",
        )
        .selectExpr(
            "*",
            f"lag({DAY}) OVER ({_history(keys)}) AS __seen_before",
            f"lag(__row) OVER ({_history(keys)}) AS __row_before",
            f"lead({DAY}) OVER ({_history(keys)}) AS __seen_next",
        )
    )
    stayed = "coalesce(__previous = __seen_before, false)"
    vanished = "__next IS NOT NULL AND NOT (__next <=> __seen_next)"
    arrival = (
        f"CASE WHEN NOT {stayed} THEN 'DELETE'"
        f" WHEN {differs(columns, '__row', '__row_before')} THEN 'UPDATE' END AS {ACTION},"
        f" {DAY}, if({stayed}, __row_before, __row) AS __row"
    )
    departure = f"if({vanished}, 'INSERT', NULL) AS {ACTION}, __next AS {DAY}, __row"
    return (
        seen.selectExpr(
            *idents(keys), f"inline(array(struct({arrival}), struct({departure})))"
        )
        .filter(f"{ACTION} IS NOT NULL")
        .selectExpr(
            *[
                ident(c) if c in keys else f"{ident(c, '__row')} AS {ident(c)}"
                for c in dumps.columns
                if c != DAY
            ],
            ACTION,
            DAY,
        )
    )


def as_of(
    snapshot: DataFrame, log: DataFrame, day: dt.date | str, keys: Sequence[str]
) -> DataFrame:
    """The table as it was on ``day``, from a later snapshot and the log up to it.

    For each key the earliest log row after ``day`` decides; a key without one
    keeps its snapshot row. Only the log is ranked and shuffled. The snapshot
    is filtered by an anti join against the keys in the log, which Spark turns
    into a broadcast when they are few; a bucketed snapshot is not shuffled
    even when they are many.
    """
    columns = idents(snapshot.columns)
    undo = log.filter(F.col(DAY) > F.lit(as_day(day)))
    restored = (
        undo.selectExpr("*", f"row_number() OVER ({_history(keys)}) AS __rank")
        .filter(f"__rank = 1 AND {ACTION} <> 'DELETE'")
        .select(*columns)
    )
    untouched = snapshot.join(undo.select(*idents(keys)), list(keys), "left_anti")
    return union_all([untouched.select(*columns), restored])


def as_of_many(
    snapshot: DataFrame,
    log: DataFrame,
    days: Sequence[dt.date | str],
    keys: Sequence[str],
) -> DataFrame:
    """The table on each of ``days`` in one job, with an ``as_of`` column first.

    Every log row and every snapshot row gets the span of days on which it was
    current. Both ends are looked up in a table of the wanted days, so a row
    costs what it gives, however many days are wanted.
    """
    wanted = sorted({as_day(d) for d in days})
    if not wanted:
        raise ValueError("no days to rebuild")
    columns = idents(snapshot.columns)
    # A row undone on or before the first wanted day matters to none of them.
    undo = log.filter(F.col(DAY) > F.lit(wanted[0]))
    past = (
        undo.selectExpr("*", f"lag({DAY}) OVER ({_history(keys)}) AS __from")
        .filter(f"{ACTION} <> 'DELETE'")
        .selectExpr(*columns, "__from", f"{DAY} AS __to")
    )
    last_undone = undo.groupBy(*idents(keys)).agg(F.max(DAY).alias("__from"))
    current = snapshot.join(last_undone, list(keys), "left").selectExpr(
        *columns, "__from", f"DATE'{FAR_FUTURE}' AS __to"
    )
    # Entry i: how many wanted days come before the i-th day from the first on.
    first, span = wanted[0], (wanted[-1] - wanted[0]).days + 1
    earlier, at = [], 0
    for n in range(span + 1):
        while at < len(wanted) and (wanted[at] - first).days < n:
            at += 1
        earlier.append(at)

    def index(day: str) -> str:
        return f"get(__earlier, least({span}, greatest(0, datediff({day}, DATE'{first}'))))"

    numbers = ", ".join(map(str, earlier))
    listed = ", ".join(f"DATE'{d}'" for d in wanted)
    spans = union_all([current, past]).selectExpr(*columns, "__from", "__to", f"array({numbers}) AS __earlier")
    return (
        spans.selectExpr(
            *columns, f"coalesce({index('__from')}, 0) AS __low", f"{index('__to')} AS __high"
        )
        .filter("__low < __high")
        .selectExpr(f"explode(slice(array({listed}), __low + 1, __high - __low)) AS as_of", *columns)
    )


def versions(snapshot: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row that the table ever had, with the day ``since`` when it held.

    ``log`` reaches up to the snapshot. Columns of ``snapshot``, then ``since``,
    null for what held before the first day of the log, and ``present``: false
    says that the key was absent from that day on, and the other columns are
    null. A version holds until the next one of its key.
    """
    columns = [c for c in snapshot.columns if c not in keys]
    row = f"struct({', '.join(idents(columns) or ['1 AS __none'])})"
    # A log row holds what was before its day, so since the day before it in the log.
    past = f"struct(__before AS since, {ACTION} <> 'DELETE' AS present, if({ACTION} <> 'DELETE', {row}, NULL) AS __row)"
    gone = f"if(__last AND {ACTION} = 'INSERT', struct({DAY} AS since, false AS present, NULL AS __row), NULL)"
    undone = log.selectExpr(
        "*",
        f"lag({DAY}) OVER ({_history(keys)}) AS __before",
        f"lead({DAY}) OVER ({_history(keys)}) IS NULL AS __last",
    ).selectExpr(*idents(keys), f"inline(filter(array({past}, {gone}), v -> v IS NOT NULL))")
    held = [f"{ident(c)}" if c in keys else f"{ident(c, '__row')} AS {ident(c)}" for c in snapshot.columns]
    last = log.groupBy(*idents(keys)).agg(F.max(DAY).alias("since"))
    current = snapshot.join(last, list(keys), "left").selectExpr(
        *idents(snapshot.columns), "since", "true AS present"
    )
    return union_all([undone.selectExpr(*held, "since", "present"), current])


def _history(keys: Sequence[str]) -> str:
    return f"PARTITION BY {', '.join(idents(keys))} ORDER BY {DAY}"
