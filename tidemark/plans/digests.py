"""Digests of key ranges, by which two snapshots tell where they differ.

A bucket's rows are dealt to ``parts`` by another hash of their keys. Each part
has its number of rows and two 64-bit hashes of them, combined by exclusive or:
the order of the rows does not matter, and digests of parts add up to those of
buckets and of the whole snapshot.

If hashes behave like random numbers, two unequal parts have equal digests with
probability 2^-128; a comparison of ``r`` parts misses a change with at most
``r`` times that. Rows chosen by someone who wants two snapshots to look alike
are not covered: the hashes are not cryptographic.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, idents

DIGEST = "bucket int, part int, n long, x long, y long"
_BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")


def places(keys: Sequence[str], buckets: int, parts: int) -> list[str]:
    """``bucket`` and ``part`` of a row; the bucket is the one it is stored in."""
    by = ", ".join(idents(keys))
    return [f"pmod(hash({by}), {buckets}) AS bucket", f"CAST(pmod(xxhash64({by}), {parts}) AS INT) AS part"]


def digests(rows: DataFrame, keys: Sequence[str], buckets: int, parts: int) -> DataFrame:
    """``bucket, part, n, x, y`` of every part that has rows."""
    # A hash skips nulls, so each value is told together with whether it is null.
    values = ", ".join(f"{c} IS NULL, {c}" for c in (ident(c) for c in rows.columns))
    hashed = rows.selectExpr(
        *places(keys, buckets, parts), f"xxhash64('x', {values}) AS __x", f"xxhash64('y', {values}) AS __y"
    )
    return hashed.groupBy("bucket", "part").agg(
        F.count("*").alias("n"), F.expr("bit_xor(__x) AS x"), F.expr("bit_xor(__y) AS y")
    )


def unequal(before: DataFrame, after: DataFrame) -> DataFrame:
    """``bucket, part, rows_before, rows_after`` of the parts that differ."""
    a, b = before.alias("a"), after.alias("b")
    same = "a.n <=> b.n AND a.x <=> b.x AND a.y <=> b.y"
    joined = a.join(b, F.expr("a.bucket = b.bucket AND a.part = b.part"), "full_outer").filter(f"NOT ({same})")
    return joined.selectExpr(
        "coalesce(a.bucket, b.bucket) AS bucket",
        "coalesce(a.part, b.part) AS part",
        "coalesce(a.n, 0L) AS rows_before",
        "coalesce(b.n, 0L) AS rows_after",
    )


def bucket_of(file_name: str) -> int | None:
    """The bucket number that Spark puts into the names of bucketed files."""
    found = _BUCKET_FILE.search(file_name)
    return int(found[1]) if found else None
