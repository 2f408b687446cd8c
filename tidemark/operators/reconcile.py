"""A rebuilt table against the dump it should equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import idents
from ..functions.unions import union_all
from .metrics import compare_metrics


def reconcile_metrics(
    rebuilt: DataFrame,
    truth: DataFrame,
    keys: Sequence[str],
    commune: str = "commune_insee",
    street: str = "voie_nom",
    unique_keys: bool = False,
) -> DataFrame:
    """One row per metric: its value on both sides, and whether they agree."""
    sides = compare_metrics(rebuilt, truth, keys, commune, street, unique_keys)
    return sides.selectExpr(
        "metric", "before AS rebuilt", "after AS truth", "before = after AS agrees"
    )


def extra_keys(rebuilt: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``rebuilt`` that ``truth`` lacks; null equals null here.

    One grouping over both sides, which map tasks start ahead of the shuffle,
    so that copies of a key do not pile up in one task as in an anti join.
    """
    columns = idents(keys)
    sides = [
        rebuilt.selectExpr(*columns, "true AS __here"),
        truth.selectExpr(*columns, "false AS __here"),
    ]
    grouped = union_all(sides).groupBy(*columns).agg(F.expr("bool_and(__here) AS __only"))
    return grouped.filter("__only").select(*columns)


def missing_keys(rebuilt: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``truth`` that ``rebuilt`` lacks."""
    return extra_keys(truth, rebuilt, keys)
