"""Reverse deltas of several days as one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import differs, ident, idents
from ..sources.schema import ACTION, DAY

# Whether the row of a DELETE is the one that undoing starts from.
EXACT = "__exact"


def merge_deltas(deltas: DataFrame, keys: Sequence[str], span: str) -> DataFrame:
    """One delta per ``span``, that undoes all its days at once.

    ``deltas`` holds reverse deltas, a key at most once a day, each with the
    ``span`` it goes into. The days of a span follow each other; a delta may
    itself be merged, and then has the last of its days as ``day``. The result
    has the same columns, with the last day that changed the key as ``day``.

    Per key, the first row says how the table was before the span, the last one
    how it was after it. A key that was absent both times has no row, nor has
    one that went and came back as it was. Any other key has one row: DELETE if
    it was absent before, else its row from before, as INSERT if it was absent
    after and as UPDATE if not.

    A DELETE holds the row that it takes away, where that is known; ``__exact``
    tells. Of a key that appeared in a span and was changed later in it, the
    row after the span is not in the log.
    """
    columns = [c for c in deltas.columns if c not in {*keys, span, ACTION, DAY, EXACT}]
    row = f"struct({', '.join(idents(columns) or ['1 AS __none'])})"
    ends = deltas.groupBy(*idents([*keys, span])).agg(
        F.expr(f"min_by(struct({ACTION}, {row} AS row), {DAY}) AS __first"),
        F.expr(f"max_by(struct({ACTION}, {row} AS row, {EXACT}), {DAY}) AS __last"),
        F.expr(f"max({DAY}) AS {DAY}"),
    )
    absent_before, absent_after = f"__first.{ACTION} = 'DELETE'", f"__last.{ACTION} = 'INSERT'"
    arrived = f"__last.{ACTION} = 'DELETE'"
    same = f"NOT ({differs(columns, '__first.row', '__last.row')})"
    action = (
        f"CASE WHEN {absent_before} THEN if({absent_after}, NULL, 'DELETE')"
        f" WHEN {absent_after} THEN 'INSERT'"
        f" WHEN {arrived} AND __last.{EXACT} AND {same} THEN NULL ELSE 'UPDATE' END"
    )
    # What undoing a DELETE takes away is the row of the last arrival.
    image = f"if({absent_before} AND {arrived}, __last.row, __first.row)"
    merged = ends.selectExpr(
        "*", f"{action} AS {ACTION}", f"{image} AS __row", f"{arrived} AND __last.{EXACT} AS {EXACT}"
    ).filter(f"{ACTION} IS NOT NULL")
    own = {**{c: ident(c) for c in [*keys, span]}, ACTION: ACTION, DAY: DAY, EXACT: EXACT}
    return merged.selectExpr(
        *[own[c] if c in own else f"{ident(c, '__row')} AS {ident(c)}" for c in deltas.columns]
    )
