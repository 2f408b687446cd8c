"""Row fingerprints.

Neither is used to detect changes: the store compares the columns themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import idents

# Fixed value: separator of the joined form of the fingerprint.
SEPARATOR = "||"


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the column values joined by ``||``.

    ``concat_ws`` leaves nulls out, so ``('a', null, 'b')`` and
    ``(null, 'a', 'b')`` get one fingerprint. Use ``row_hash_named`` to tell
    them apart.
    """
    values = ", ".join(f"CAST({c} AS STRING)" for c in idents(columns))
    return F.expr(f"sha2(concat_ws('{SEPARATOR}', {values}), 256)")


def row_hash_named(columns: Sequence[str]) -> Column:
    """SHA-256 of the row as JSON, in which every value carries its name."""
    return F.expr(f"sha2(to_json(struct({', '.join(idents(columns))})), 256)")
