"""Operators: functions from DataFrames to DataFrames, lazy throughout."""

from .changes import (
    added_rows,
    change_sample,
    change_summary,
    column_differences,
    compare,
    log_summary,
    modified_rows,
    removed_rows,
    reverse_delta,
)
from .clean import clean, dedupe, rejections
from .day_sketches import day_sketches, united_metrics
from .frequent import frequency_sketches, frequent_items
from .history import as_of, as_of_many, calendar, reverse_log, versions
from .key_sketch import key_sketch, reconcile_keys
from .merging import merge_deltas
from .metrics import compare_metrics, rows_per_prefix, snapshot_metrics, snapshot_report
from .point_in_time import point_in_time
from .reconcile import extra_keys, missing_keys, reconcile_metrics
from .sparse import as_of_thin, column_changes, dense_log, thin_log

__all__ = [
    "added_rows",
    "as_of",
    "as_of_many",
    "as_of_thin",
    "calendar",
    "change_sample",
    "change_summary",
    "clean",
    "column_changes",
    "column_differences",
    "compare",
    "compare_metrics",
    "day_sketches",
    "dedupe",
    "dense_log",
    "extra_keys",
    "frequency_sketches",
    "frequent_items",
    "key_sketch",
    "log_summary",
    "merge_deltas",
    "missing_keys",
    "modified_rows",
    "point_in_time",
    "reconcile_keys",
    "reconcile_metrics",
    "rejections",
    "removed_rows",
    "reverse_delta",
    "reverse_log",
    "rows_per_prefix",
    "snapshot_metrics",
    "snapshot_report",
    "thin_log",
    "united_metrics",
    "versions",
]
