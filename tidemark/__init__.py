"""Snapshot history on Spark: daily full dumps in, any past day out."""

from .functions import Rule, key_rules, row_hash, row_hash_named
from .operators import (
    added_rows,
    as_of,
    as_of_many,
    as_of_thin,
    change_sample,
    change_summary,
    clean,
    column_changes,
    column_differences,
    compare,
    compare_metrics,
    dedupe,
    dense_log,
    extra_keys,
    frequency_sketches,
    frequent_items,
    key_sketch,
    log_summary,
    missing_keys,
    modified_rows,
    point_in_time,
    reconcile_keys,
    reconcile_metrics,
    rejections,
    removed_rows,
    reverse_delta,
    reverse_log,
    rows_per_prefix,
    snapshot_metrics,
    snapshot_report,
    thin_log,
    versions,
)
from .operators.metrics import approximate_metrics
from .plans import (
    DiffReport,
    HistoryStore,
    RebuildReport,
    diff,
    integrate,
    rebuild,
    report,
)
from . import streaming
from .sources import ADDRESS_KEYS, ADDRESS_SCHEMA, conform, dump_path, log_schema, read_dump

__all__ = [
    "ADDRESS_KEYS",
    "ADDRESS_SCHEMA",
    "DiffReport",
    "HistoryStore",
    "RebuildReport",
    "Rule",
    "added_rows",
    "approximate_metrics",
    "as_of",
    "as_of_many",
    "as_of_thin",
    "change_sample",
    "change_summary",
    "clean",
    "column_changes",
    "column_differences",
    "compare",
    "compare_metrics",
    "conform",
    "dedupe",
    "dense_log",
    "diff",
    "dump_path",
    "extra_keys",
    "frequency_sketches",
    "frequent_items",
    "integrate",
    "key_rules",
    "key_sketch",
    "log_schema",
    "log_summary",
    "missing_keys",
    "modified_rows",
    "point_in_time",
    "read_dump",
    "rebuild",
    "reconcile_keys",
    "reconcile_metrics",
    "rejections",
    "removed_rows",
    "report",
    "reverse_delta",
    "reverse_log",
    "row_hash",
    "row_hash_named",
    "rows_per_prefix",
    "snapshot_metrics",
    "snapshot_report",
    "streaming",
    "thin_log",
    "versions",
]
