"""The most frequent items of a log, from small sketches and one exact look.

A sketch of bounded size keeps counters for the items that may be frequent.
Sketches of days unite, so those of any days tell the candidates without a
count of every item. A second pass counts the candidates alone, exactly.

A sketch with room for ``m`` items is off by ``3.5 / m`` of what it has seen at
most, and names every item above twice that. Room for ``8 * per`` items is
therefore enough for all with a share of ``1 / per`` or more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, idents

ROOM = 8
# Fixed value: Spark's limit on the items of a sketch.
MOST_TRACKED = 1_000_000
# Spark cannot combine sketches over an empty partition without any group.
_ALL = "true AS __all"


def frequency_sketches(rows: DataFrame, items: Sequence[str], per: int, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` (the rows) and ``sketch``, for items with a share of ``1 / per`` or more.

    An item is the values of the columns ``items``, nulls as values of their own.
    A group's sketch has ``8 * per`` counters at most, and is combined ahead of
    the shuffle, so a frequent item or a large group makes no large task. No
    rows, no sketch.
    """
    given = rows.selectExpr(*idents(by), f"{_item(items)} AS __item")
    sketch = F.expr(f"approx_top_k_accumulate(__item, {_tracked(per)}) AS sketch")
    return given.groupBy(*idents(by), F.expr(_ALL)).agg(F.count("*").alias("n"), sketch).drop("__all")


def frequent_items(rows: DataFrame, sketches: DataFrame, items: Sequence[str], per: int) -> DataFrame:
    """``items``, ``n`` and ``total``: all items that at least ``1 / per`` of ``rows`` have, with exact counts.

    ``sketches`` are those of all ``rows``, in any number of groups, taken for
    the same ``per``. The candidates are broadcast as hashes, 8 bytes for each
    of ``8 * per`` at most, so ``rows`` are not shuffled, and only candidates
    are grouped. Hashes that collide bring in items that the exact share then drops.
    """
    united = sketches.groupBy(F.expr(_ALL)).agg(
        F.sum("n").alias("total"), F.expr("approx_top_k_combine(sketch) AS sketch")
    )
    likely = (
        united.selectExpr("total", f"inline(approx_top_k_estimate(sketch, {_tracked(per)}))")
        .selectExpr("xxhash64(item) AS __hash", "total")
        .dropDuplicates(["__hash"])
    )
    return (
        rows.selectExpr(*idents(items), f"xxhash64({_item(items)}) AS __hash")
        .join(F.broadcast(likely), "__hash")
        .groupBy(*idents(items))
        .agg(F.count("*").alias("n"), F.max("total").alias("total"))
        .filter(f"CAST(n AS DECIMAL(20, 0)) * {per} >= total")
    )


def _item(items: Sequence[str]) -> str:
    if not items:
        raise ValueError("no columns make up an item")
    values = ", ".join(f"{ident(c)} AS _{i}" for i, c in enumerate(items))
    return f"to_json(struct({values}), map('ignoreNullFields', 'false'))"


def _tracked(per: int) -> int:
    if not 1 <= per <= MOST_TRACKED // ROOM:
        raise ValueError(f"a share of one in 1 to {MOST_TRACKED // ROOM}, not one in {per}")
    return ROOM * per
