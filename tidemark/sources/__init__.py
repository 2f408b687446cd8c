"""Schemas and readers: CSV dumps, snapshot folders, change logs."""

from .bucketed import read_bucketed, write_bucketed
from .dumps import dump_path, read_dump
from .schema import (
    ADDRESS_KEYS,
    ADDRESS_SCHEMA,
    as_day,
    conform,
    log_schema,
)

__all__ = [
    "ADDRESS_KEYS",
    "ADDRESS_SCHEMA",
    "as_day",
    "conform",
    "dump_path",
    "log_schema",
    "read_bucketed",
    "read_dump",
    "write_bucketed",
]
