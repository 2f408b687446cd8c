"""Reverse logs that hold only what changed.

A full log repeats every column of a row for each change of one of them. A thin
log tells in ``changed``, a bitmap, which columns a log row speaks of, and holds
only their old values. So a null is told from a column that did not change. An
INSERT speaks of all columns; a DELETE of none, as undoing it takes no values.

What a column was after a day is told by the next log row of the key that
speaks of it, or else by the snapshot. Nothing is lost: ``dense_log`` gives the
full log back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, idents
from ..functions.unions import union_all
from ..sources.schema import ACTION, DAY, as_day

CHANGED = "changed"
# Columns to a word of the bitmap, whose masks are positive numbers.
WORD = 63


def thin_log(log: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``log`` with ``changed``, and null for the values that did not change.

    ``snapshot`` is the table after the last day of ``log``, a full reverse log.
    Only its rows with keys of the log are shuffled, and one sort by key and
    day brings each log row next to what came after it.
    """
    if CHANGED in log.columns:
        raise ValueError(f"the log has a column {CHANGED} already")
    columns = _values(log.columns, keys)
    row = f"struct({', '.join(idents(columns) or ['1 AS __none'])}) AS __row"
    touched = snapshot.join(log.select(*idents(keys)), list(keys), "left_semi")
    rows = union_all(
        [
            log.selectExpr(*idents(keys), ACTION, DAY, row),
            touched.selectExpr(*idents(keys), f"CAST(NULL AS STRING) AS {ACTION}", f"CAST(NULL AS DATE) AS {DAY}", row),
        ]
    )
    by_key = f"PARTITION BY {', '.join(idents(keys))} ORDER BY {DAY} NULLS LAST"
    after = rows.selectExpr("*", f"lead(__row) OVER ({by_key}) AS __after").filter(f"{ACTION} IS NOT NULL")
    speaks = [
        f"{ACTION} = 'INSERT' OR {ACTION} = 'UPDATE' AND"
        f" (__after IS NULL OR NOT ({ident(c, '__row')} <=> {ident(c, '__after')}))"
        for c in columns
    ]
    marked = after.selectExpr("*", f"{_bitmap(speaks)} AS {CHANGED}")
    told = {c: f"if({_told(i)}, {ident(c, '__row')}, NULL) AS {ident(c)}" for i, c in enumerate(columns)}
    return marked.selectExpr(*[told.get(c, ident(c)) for c in log.columns], CHANGED)


def dense_log(thin: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The full log that ``thin`` was made of; ``snapshot`` is the table after its last day.

    One sort by key and one pass from the newest day back, which carries along
    what each column was.
    """
    columns = _values(thin.columns, keys)
    touched = snapshot.join(thin.select(*idents(keys)), list(keys), "left_semi")
    rows = union_all(
        [
            thin,
            touched.selectExpr(
                *idents([*keys, *columns]),
                f"CAST(NULL AS STRING) AS {ACTION}",
                f"CAST(NULL AS DATE) AS {DAY}",
                f"{_bitmap(['true'] * len(columns))} AS {CHANGED}",
            ),
        ]
    )
    back = (
        f"PARTITION BY {', '.join(idents(keys))} ORDER BY {DAY} DESC NULLS FIRST"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    )
    known = [
        f"last_value(if({_told(i)}, struct({ident(c)} AS v), NULL)) IGNORE NULLS OVER ({back}) AS __{i}"
        for i, c in enumerate(columns)
    ]
    held = {c: f"__{i}.v AS {ident(c)}" for i, c in enumerate(columns)}
    names = [c for c in thin.columns if c != CHANGED]
    folded = rows.selectExpr(*idents([*keys, ACTION, DAY]), *known).filter(f"{ACTION} IS NOT NULL")
    return folded.selectExpr(*[held.get(c, ident(c)) for c in names])


def as_of_thin(snapshot: DataFrame, thin: DataFrame, day: dt.date | str, keys: Sequence[str]) -> DataFrame:
    """The table as it was on ``day``, from a later snapshot and the thin log up to it.

    Per key, one aggregate finds the earliest row after ``day`` that speaks of
    each column; it is combined ahead of its shuffle. A column that none speaks
    of has the snapshot's value. The snapshot meets the log in a left join: it
    is not shuffled where the log is small or the snapshot bucketed.
    """
    columns = _values(thin.columns, keys)
    undo = thin.filter(F.col(DAY) > F.lit(as_day(day)))
    folded = undo.groupBy(*idents(keys)).agg(
        F.expr(f"min_by({ACTION}, {DAY}) AS __first"),
        F.expr(f"max_by({ACTION}, {DAY}) AS __last"),
        *[
            F.expr(f"min_by(struct({ident(c)} AS v), {DAY}) FILTER (WHERE {_told(i)}) AS __{i}")
            for i, c in enumerate(columns)
        ],
    )
    place = {c: i for i, c in enumerate(columns)}
    present = snapshot.join(folded, list(keys), "left").filter("__first IS NULL OR __first <> 'DELETE'")
    stayed = present.selectExpr(
        *[f"if(__{place[c]} IS NULL, {ident(c)}, __{place[c]}.v) AS {ident(c)}" if c in place else ident(c) for c in snapshot.columns]
    )
    # A key that is not in the snapshot was removed last, with all its values.
    vanished = folded.filter("__last = 'INSERT' AND __first <> 'DELETE'").selectExpr(
        *[f"__{place[c]}.v AS {ident(c)}" if c in place else ident(c) for c in snapshot.columns]
    )
    return union_all([stayed, vanished])


def column_changes(thin: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``column``, ``changes``: how many UPDATEs changed each column, read off the bitmaps.

    Every group of ``by`` has a row for each column, whose count may be 0.
    """
    columns = _values(thin.columns, keys)
    counts = [
        F.expr(f"count_if({ACTION} = 'UPDATE' AND {_told(i)}) AS __{i}") for i in range(len(columns))
    ]
    told = ", ".join(f"struct({_text(c)} AS column, __{i} AS changes)" for i, c in enumerate(columns))
    if not columns:
        raise ValueError("the log has no columns besides its keys")
    return thin.groupBy(*idents(by)).agg(*counts).selectExpr(*idents(by), f"inline(array({told}))")


def _values(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in {*keys, ACTION, DAY, CHANGED}]


def _bitmap(conditions: Sequence[str]) -> str:
    words = [conditions[i : i + WORD] for i in range(0, len(conditions), WORD)]
    sums = [" | ".join(f"if({c}, {1 << i}L, 0L)" for i, c in enumerate(word)) for word in words]
    return f"array({', '.join(sums)})" if sums else "CAST(array() AS ARRAY<BIGINT>)"


def _told(i: int) -> str:
    """True when a log row speaks of column ``i``."""
    return f"((get({CHANGED}, {i // WORD}) & {1 << i % WORD}L) <> 0)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
