"""Cleaning: row rules, then one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, failing_rule, key_rules, passes
from ..functions.text import ident, idents


def clean(
    df: DataFrame,
    keys: Sequence[str],
    rules: Sequence[Rule] | None = None,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """Rows that meet every rule (by default ``key_rules``), one per key."""
    rules = key_rules(df.schema, keys) if rules is None else rules
    return dedupe(df.filter(passes(rules)), keys, prefer)


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``prefer``, then by all other columns.

    ``prefer`` holds SQL sort terms such as ``"ts DESC"``. The order is total
    over the columns, so the surviving values do not depend on file layout or
    task order. Spark limits each map task to its best row per key ahead of
    the shuffle, so even a key that holds a large share of the rows sends at
    most one row per task to the reducer.
    """
    ties = [f"{ident(c)} ASC NULLS LAST" for c in df.columns if c not in keys]
    order = ", ".join([*prefer, *ties] or idents(keys))
    rank = f"row_number() OVER (PARTITION BY {', '.join(idents(keys))} ORDER BY {order})"
    return df.selectExpr("*", f"{rank} AS __rank").filter("__rank = 1").drop("__rank")


def rejections(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """How many rows each rule rejects; a row counts under the first it breaks."""
    return (
        df.selectExpr(f"{failing_rule(rules)} AS rule")
        .filter("rule IS NOT NULL")
        .groupBy("rule")
        .agg(F.count("*").alias("rejected"))
    )
