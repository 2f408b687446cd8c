"""Facts joined with the version of a row that held at their own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, idents
from ..functions.unions import union_all

SALTS = 32


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str = "since",
    present: str | None = None,
    most: int = 1_000_000,
    ranges: int = 200,
) -> DataFrame:
    """Each fact with the latest version of its key that began at or before its time.

    ``facts`` holds the keys and the time ``at``; ``versions`` the keys, the
    time ``since`` of the same type (null: since ever; at most one version of a
    key begins at a time) and the columns to add. A version whose column
    ``present`` is false says that there is nothing from then on. Returns the
    columns of ``facts``, those to add (null where there is no version) and
    ``found``. Facts stay as they are, repeated ones too; without a key or a
    time they find nothing.

    Facts and versions of a key meet in one sort, and one pass carries the
    latest version on to the facts; no pairs are made. Keys with more than ``most`` facts
    and versions are cut into ``ranges`` of time with about as many of them,
    and each range gets the version that held at its beginning. Facts at one
    and the same time may be spread over several ranges, if they differ in anything.
    """
    if ranges < 2:
        raise ValueError("a key is cut into two ranges at least")
    added = [c for c in versions.columns if c not in {*keys, since, present}]
    clash = {*added, "found"} & set(facts.columns)
    if clash:
        raise ValueError(f"columns that both sides have: {sorted(clash)}")
    if facts.schema[at].dataType != versions.schema[since].dataType:
        raise TypeError(f"{at} is {facts.schema[at].dataType}, {since} is {versions.schema[since].dataType}")

    by = idents(keys)
    whole = " AND ".join(f"{k} IS NOT NULL" for k in by)
    fact = f"struct({', '.join(idents(facts.columns))}) AS __fact"
    row = f"struct({f'{ident(present)} AS __present' if present else 'true AS __present'}, "
    row += f"struct({', '.join(idents(added) or ['1 AS __none'])}) AS __row) AS __version"
    timed = f"{whole} AND {ident(at)} IS NOT NULL"
    asked = facts.filter(timed).selectExpr(*by, f"{ident(at)} AS __at", fact)
    given = versions.filter(whole).selectExpr(*by, f"{ident(since)} AS __at", row)

    hot = _hot_keys(asked, given, keys, most, ranges)
    asked, given = _ranged(asked, hot, keys, spread=True), _ranged(given, hot, keys, spread=False)
    carried = _carried(given, hot, keys, ranges)
    version_type = given.schema["__version"].dataType.simpleString()
    fact_type = asked.schema["__fact"].dataType.simpleString()
    place = [*by, "__range", "__at"]
    rows = union_all(
        [
            given.selectExpr(*place, "1 AS __side", f"CAST(NULL AS {fact_type}) AS __fact", "__version"),
            asked.selectExpr(*place, "2 AS __side", "__fact", f"CAST(NULL AS {version_type}) AS __version"),
            carried.selectExpr(*place, "0 AS __side", f"CAST(NULL AS {fact_type}) AS __fact", "__version"),
        ]
    )
    order = f"PARTITION BY {', '.join(by)}, __range ORDER BY __at NULLS FIRST, __side"
    latest = f"last_value(__version) IGNORE NULLS OVER ({order} ROWS UNBOUNDED PRECEDING) AS __held"
    met = rows.selectExpr("__side", "__fact", latest).filter("__side = 2")
    found = "coalesce(__held.__present, false)"
    joined = met.selectExpr(
        "__fact.*", *[f"if({found}, {ident(c, '__held.__row')}, NULL) AS {ident(c)}" for c in added], f"{found} AS found"
    )
    types = {f.name: f.dataType.simpleString() for f in versions.schema.fields}
    untimed = facts.filter(f"NOT ({timed})").selectExpr(
        *idents(facts.columns), *[f"CAST(NULL AS {types[c]}) AS {ident(c)}" for c in added], "false AS found"
    )
    return union_all([joined, untimed])


def _hot_keys(asked: DataFrame, given: DataFrame, keys: Sequence[str], most: int, ranges: int) -> DataFrame:
    """The keys with more than ``most`` rows and the times ``__bounds`` that cut these into ``ranges``.

    Map tasks count and sketch ahead of the shuffle.
    """
    shares = ", ".join(f"{i / ranges}D" for i in range(1, ranges)) or "0.5D"
    every = union_all([side.select(*idents(keys), "__at") for side in (asked, given)])
    return (
        every.groupBy(*idents(keys))
        .agg(F.count("*").alias("__n"), F.expr(f"approx_percentile(__at, array({shares})) AS __bounds"))
        .filter(f"__n > {most}")
        .select(*idents(keys), "__bounds")
    )


def _ranged(rows: DataFrame, hot: DataFrame, keys: Sequence[str], spread: bool) -> DataFrame:
    """``rows`` with the number ``__range`` of their range, 0 for keys that are not cut.

    A time that is a bound itself belongs to several ranges: to the first one, or if
    ``spread`` to any.
    """
    # A hot key meets its bounds in several places.
    salted = hot.selectExpr("*", f"explode(sequence(0, {SALTS - 1})) AS __salt")
    salt = f"CAST(pmod(xxhash64({', '.join(idents(rows.columns))}), {SALTS}) AS INT) AS __salt"
    below = "size(filter(__bounds, b -> b < __at))"
    upto = "size(filter(__bounds, b -> b <= __at))"
    drawn = f"CAST(pmod(xxhash64(__salt, {', '.join(idents(rows.columns))}), {upto} - {below} + 1) AS INT)"
    number = f"{below} + {drawn}" if spread else below
    joined = rows.selectExpr("*", salt).join(salted, [*keys, "__salt"], "left")
    return joined.selectExpr(
        *idents(rows.columns), f"if(__bounds IS NULL OR __at IS NULL, 0, {number}) AS __range"
    )


def _carried(given: DataFrame, hot: DataFrame, keys: Sequence[str], ranges: int) -> DataFrame:
    """For each range of a hot key the version that held when it began, if any."""
    by = idents(keys)
    lasts = given.groupBy(*by, "__range").agg(F.expr("max_by(__version, struct(__at)) AS __version"))
    cut = hot.selectExpr(*by, f"explode(sequence(0, {ranges - 1})) AS __range")
    order = f"PARTITION BY {', '.join(by)} ORDER BY __range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    time = given.schema["__at"].dataType.simpleString()
    return (
        cut.join(lasts, [*keys, "__range"], "left")
        .selectExpr(*by, "__range", f"last_value(__version) IGNORE NULLS OVER ({order}) AS __version")
        .filter("__version IS NOT NULL")
        .selectExpr(*by, "__range", f"CAST(NULL AS {time}) AS __at", "__version")
    )
