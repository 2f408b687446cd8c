"""The four jobs: integrate a day, report, rebuild a day, compare two snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import idents
from ..operators import changes, metrics, reconcile
from ..sources.dumps import dump_path, read_dump
from ..sources.schema import ADDRESS_KEYS
from .scratch import scratch_folder
from .store import HistoryStore

# The columns a listing of rows or of modifications shows.
ROW_COLUMNS = ["commune_nom", "voie_nom", "numero"]
MODIFIED_COLUMNS = {"commune": "commune_nom", "voie": "voie_nom"}


def integrate(store: HistoryStore, day: dt.date | str, csv: str) -> DataFrame:
    """Ingest a day's CSV dump; returns its change summary.

    Malformed lines do not enter; ``store.refusals()`` counts them.
    """
    return store.ingest(day, read_dump(store.spark, csv, store.schema, mark=True))


def report(
    store: HistoryStore, commune: str = "commune_insee", street: str = "voie_nom"
) -> DataFrame:
    """Metrics of the newest snapshot."""
    return store.report(commune, street)


@dataclass(frozen=True)
class RebuildReport:
    """A rebuilt dump against its original."""

    rebuilt: DataFrame
    metrics: DataFrame
    extra: DataFrame
    missing: DataFrame
    changes: DataFrame


def rebuild(
    store: HistoryStore,
    day: dt.date | str,
    out: str,
    truth_folder: str | None = None,
    commune: str = "commune_insee",
    street: str = "voie_nom",
) -> RebuildReport | None:
    """Write the table as of ``day`` to ``out``.

    With the folder of the original dumps, also compare the two: metrics,
    extra and missing keys, and every differing row. The original is cleaned
    just as it was on ingest.
    """
    store.as_of(day).write.mode("overwrite").parquet(out)
    if truth_folder is None:
        return None
    spark = store.spark
    rebuilt = spark.read.schema(store.schema).parquet(out)
    path = dump_path(spark, truth_folder, day)
    truth = store.clean(read_dump(spark, path, store.schema, mark=True))
    return RebuildReport(
        rebuilt=rebuilt,
        metrics=reconcile.reconcile_metrics(
            rebuilt, truth, store.keys, commune, street, unique_keys=True
        ),
        extra=reconcile.extra_keys(rebuilt, truth, store.keys),
        missing=reconcile.missing_keys(rebuilt, truth, store.keys),
        changes=changes.compare(truth, rebuilt, store.keys, ignore=(), unique_keys=True),
    )


@dataclass(frozen=True)
class DiffReport:
    """Everything that differs between two snapshot folders."""

    metrics: DataFrame
    columns: DataFrame
    summary: DataFrame
    removed: DataFrame
    added: DataFrame
    modified: DataFrame

    def identical(self) -> bool:
        """No row and no column differs."""
        return self.summary.first()["total"] == 0 and self.columns.isEmpty()


def diff(
    spark: SparkSession,
    before: str,
    after: str,
    keys: Sequence[str] = tuple(ADDRESS_KEYS),
    row_columns: Sequence[str] = tuple(ROW_COLUMNS),
    modified_columns: Mapping[str, str] = MODIFIED_COLUMNS,
    commune: str = "commune_insee",
    street: str = "voie_nom",
    out: str | None = None,
    unique_keys: bool = False,
) -> DiffReport:
    """Compare two Parquet folders.

    The comparison runs once and is written to ``out`` (by default a scratch
    folder), split by kind of change; counts and listings read it back.
    """
    a, b = spark.read.parquet(before), spark.read.parquet(after)
    found = changes.compare(a, b, keys, unique_keys=unique_keys)
    out = out or scratch_folder(spark)
    schema = found.schema
    by_key = [F.col(k) for k in idents(keys)]
    found.hint("rebalance", *by_key).write.mode("overwrite").partitionBy("change").parquet(out)
    found = spark.read.schema(schema).parquet(out)
    keys = list(keys)
    return DiffReport(
        metrics=metrics.compare_metrics(a, b, keys, commune, street, unique_keys),
        columns=changes.column_differences(a, b),
        summary=changes.change_summary(found),
        removed=changes.removed_rows(found, keys, row_columns),
        added=changes.added_rows(found, keys, row_columns),
        modified=changes.modified_rows(found, keys, modified_columns),
    )
