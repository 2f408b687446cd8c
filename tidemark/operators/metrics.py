"""Counts over a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, idents
from ..functions.unions import union_all

METRICS = ["addresses", "communes", "streets", "departments"]


# The value whose distinct count each metric is.
_VALUES = {"communes": "__commune", "streets": "__street", "departments": "__department"}


def snapshot_report(
    df: DataFrame, commune: str = "commune_insee", street: str = "voie_nom"
) -> DataFrame:
    """Rows, distinct communes, streets and departments; a null counts as one value.

    Rows are first counted per commune and street, which map tasks do before
    the shuffle and which skew cannot hurt; only the groups, not the rows, then
    go through the three distinct counts.
    """
    return _groups(df, commune, street, "count(*)").agg(
        F.expr("coalesce(sum(__n), 0) AS addresses"),
        *[
            F.expr(f"count(DISTINCT {v}) + coalesce(max(int({v} IS NULL)), 0) AS {name}")
            for name, v in _VALUES.items()
        ],
    )


def snapshot_metrics(
    df: DataFrame,
    keys: Sequence[str],
    commune: str = "commune_insee",
    street: str = "voie_nom",
    unique_keys: bool = False,
) -> DataFrame:
    """Distinct keys, communes, streets and departments; nulls are not counted.

    With ``unique_keys=True`` distinct keys are just rows, and the keys need
    no shuffle.
    """
    if unique_keys:
        rows = f"count({', '.join(idents(keys))})"
        groups = _groups(df, commune, street, rows)
        addresses = "coalesce(sum(__n), 0)"
    else:
        groups = df.selectExpr(*idents(keys), *_values(commune, street))
        addresses = f"count(DISTINCT {', '.join(idents(keys))})"
    return groups.agg(
        F.expr(f"{addresses} AS addresses"),
        *[F.expr(f"count(DISTINCT {v}) AS {name}") for name, v in _VALUES.items()],
    )


def compare_metrics(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    commune: str = "commune_insee",
    street: str = "voie_nom",
    unique_keys: bool = False,
) -> DataFrame:
    """``snapshot_metrics`` of two sides: one row per metric, with both values."""
    sides = [
        snapshot_metrics(df, keys, commune, street, unique_keys)
        .unpivot([], METRICS, "metric", "value")
        .selectExpr("metric", f"'{side}' AS side", "value")
        for side, df in (("before", before), ("after", after))
    ]
    return (
        union_all(sides)
        .groupBy("metric")
        .agg(*[F.expr(f"max(value) FILTER (WHERE side = '{s}') AS {s}") for s in ("before", "after")])
    )


def rows_per_prefix(df: DataFrame, code: str = "commune_insee", length: int = 2) -> DataFrame:
    """Rows per leading characters of a code, in their order."""
    return (
        df.selectExpr(f"{_prefix(code, length)} AS prefix")
        .groupBy("prefix")
        .agg(F.count("*").alias("n_rows"))
        .orderBy("prefix")
    )


def approximate_metrics(
    df: DataFrame,
    keys: Sequence[str],
    commune: str = "commune_insee",
    street: str = "voie_nom",
    rsd: float = 0.02,
) -> DataFrame:
    """``snapshot_metrics`` estimated in one pass, without shuffling values."""
    key = ", ".join(idents(keys))
    present = " AND ".join(f"{k} IS NOT NULL" for k in idents(keys))
    return df.selectExpr(
        f"if({present}, xxhash64({key}), NULL) AS __address", *_values(commune, street)
    ).agg(
        F.approx_count_distinct("__address", rsd).alias("addresses"),
        *[F.approx_count_distinct(v, rsd).alias(name) for name, v in _VALUES.items()],
    )


def _prefix(code: str, length: int = 2) -> str:
    return f"substring(CAST({ident(code)} AS STRING), 1, {length})"


def _values(commune: str, street: str) -> list[str]:
    return [
        f"{ident(commune)} AS __commune",
        f"{ident(street)} AS __street",
        f"{_prefix(commune)} AS __department",
    ]


def _groups(df: DataFrame, commune: str, street: str, rows: str) -> DataFrame:
    grouped = df.groupBy(ident(commune), ident(street)).agg(F.expr(f"{rows} AS __n"))
    return grouped.selectExpr("__n", *_values(commune, street))
