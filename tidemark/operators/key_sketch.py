"""Extra and missing keys from two small tables of their keys.

An invertible lookup table per bucket of keys. Each key enters three cells of its
bucket; a cell holds how many keys it has, and the exclusive or of their hashes
and of their texts. What two sides have in common cancels out when their tables
are subtracted; a cell left with a single key gives that key back, taking it out
of its other cells lays open the next, and so on. A bucket with more
differences than its cells can give back is compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ident, idents
from ..functions.unions import union_all

EXTRA, MISSING = "extra", "missing"
HASHES = 3
# Longs that hold the text of a key; longer texts are left to the comparison by key.
LANES = 8
# The row of a bucket that counts them.
LONG = -1
# What ``xxhash64`` starts with, and with what it goes on after the text 'cells'.
SEED = 42
CELL_SEED = xxhash.xxh64_intdigest(b"cells", SEED)


def _lanes() -> list[str]:
    return [f"lane{i}" for i in range(LANES)]


def _text(keys: Sequence[str]) -> str:
    """A key's columns as one text, which ``from_json`` reads back; nulls are left out there."""
    return f"to_json(struct({', '.join(f'{ident(k)} AS k{i}' for i, k in enumerate(keys))}))"


def key_sketch(
    rows: DataFrame, keys: Sequence[str], buckets: int = 256, cells: int = 96, unique_keys: bool = False
) -> DataFrame:
    """``bucket, cell, n, h`` and the lanes of the text: a table of at most ``buckets * cells`` rows and a few.

    Tells some ``cells / 2`` differences per bucket, however many keys there are. Cells
    without keys are left out. ``unique_keys=True`` promises that no key
    repeats; else the keys are made distinct first.
    """
    if cells % HASHES or cells < HASHES:
        raise ValueError(f"{cells} cells cannot be dealt to {HASHES} hashes")
    wanted = rows.select(*idents(keys))
    texts = (wanted if unique_keys else wanted.distinct()).selectExpr(f"{_text(keys)} AS __text").selectExpr(
        "CAST(__text AS BINARY) AS __bytes",
        "xxhash64(__text) AS h",
        "xxhash64('cells', __text) AS __cells",
        f"pmod(xxhash64(__text), {buckets}L) AS bucket",
    )
    width = cells // HASHES
    # Shifted by one at least, or the number would count as signed here.
    at = [f"CAST(pmod(shiftrightunsigned(__cells, {20 * i + 1}), {width}L) + {width * i} AS INT)" for i in range(HASHES)]
    padded = f"rpad(__bytes, {8 * LANES}, X'00')"
    lane = [
        f"CAST(conv(hex(substring({padded}, {8 * i + 1}, 8)), 16, -10) AS LONG) AS {name}"
        for i, name in enumerate(_lanes())
    ]
    fits = f"octet_length(__bytes) <= {8 * LANES}"
    entered = texts.selectExpr(
        "bucket", "h", "__cells", *lane, f"if({fits}, array({', '.join(at)}), array({LONG})) AS __at"
    ).selectExpr("bucket", "explode(__at) AS cell", "h", *_lanes())
    return entered.groupBy("bucket", "cell").agg(
        F.count("*").alias("n"), *[F.expr(f"bit_xor({c}) AS {c}") for c in ("h", *_lanes())]
    )


def sketch_differences(before: DataFrame, after: DataFrame, cells: int = 96) -> DataFrame:
    """``bucket, side, text`` of the keys that only one of two sketches has.

    ``extra`` are those of ``before`` alone. A bucket that cannot be read back has one row, without a side. Each
    bucket is read back in a task, from at most ``cells`` rows.
    """
    columns = ["h", *_lanes()]
    signed = union_all([before.selectExpr("*", "1 AS __s"), after.selectExpr("*", "-1 AS __s")])
    left = (
        signed.groupBy("bucket", "cell")
        .agg(
            F.expr("sum(n * __s) AS n"),
            F.expr("sum(n) AS __held"),
            *[F.expr(f"bit_xor({c}) AS {c}") for c in columns],
        )
        .filter(" OR ".join(["n <> 0", *[f"{c} <> 0" for c in columns], f"cell = {LONG}"]))
    )

    def peel(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = rows["bucket"].iat[0]
        found = None if (rows["cell"] == LONG).any() else _peel(rows, cells)
        if found is None:
            found = [(None, None)]
        return pd.DataFrame([(bucket, *f) for f in found], columns=["bucket", "side", "text"])

    return left.groupBy("bucket").applyInPandas(peel, "bucket long, side string, text string")


def _peel(rows: pd.DataFrame, cells: int) -> list[tuple[str, str]] | None:
    """The keys of one bucket's cells and their sides; none if some cannot be told."""
    n = np.zeros(cells, np.int64)
    held = np.zeros((cells, 1 + LANES), np.uint64)
    at = rows["cell"].to_numpy()
    n[at] = rows["n"]
    held[at] = rows[["h", *_lanes()]].to_numpy(np.int64).view(np.uint64)
    width, found = cells // HASHES, []
    waiting = list(range(cells))
    while waiting:
        cell = waiting.pop()
        if abs(n[cell]) != 1:
            continue
        text = held[cell, 1:].astype(">u8").tobytes().rstrip(b"\0")
        if xxhash.xxh64_intdigest(text, SEED) != int(held[cell, 0]):
            continue
        sign, key = n[cell], held[cell].copy()
        spread = xxhash.xxh64_intdigest(text, CELL_SEED)
        # All of a key's cells change, and may now hold a single one.
        for i in range(HASHES):
            other = (spread >> (20 * i + 1)) % width + width * i
            n[other] -= sign
            held[other] ^= key
            waiting.append(other)
        found.append((EXTRA if sign > 0 else MISSING, text.decode()))
        if len(found) > cells:
            return None
    return None if n.any() or held.any() else found


def reconcile_keys(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    sketches: Sequence[DataFrame] | None = None,
    buckets: int = 256,
    cells: int = 96,
    unique_keys: bool = False,
) -> DataFrame:
    """The keys that only one side has, and its ``side``: ``extra`` in ``before``, ``missing`` from it.

    Null equals null here. ``sketches`` are those of both sides as stored, made
    with the same ``buckets`` and ``cells``; without them they are computed. The
    rows themselves are read only for the buckets that a sketch cannot tell.
    A key that is told falsely has passed a 64-bit hash by chance.
    """
    a, b = sketches or [key_sketch(side, keys, buckets, cells, unique_keys) for side in (before, after)]
    found = sketch_differences(a, b, cells)
    schema = T.StructType([T.StructField(f"k{i}", before.schema[k].dataType) for i, k in enumerate(keys)])
    told = found.filter("side IS NOT NULL").select("side", F.from_json("text", schema).alias("__key"))
    told = told.selectExpr(*[f"__key.k{i} AS {ident(k)}" for i, k in enumerate(keys)], "side")

    # At most a number per bucket.
    failed = found.filter("side IS NULL").select("bucket")
    sides = [
        rows.selectExpr(*idents(keys), f"{here} AS __here", f"pmod(xxhash64({_text(keys)}), {buckets}L) AS bucket")
        .join(failed, "bucket", "left_semi")
        .drop("bucket")
        for rows, here in ((before, "true"), (after, "false"))
    ]
    by_key = union_all(sides).groupBy(*idents(keys)).agg(F.expr("every(__here) AS __a"), F.expr("some(__here) AS __b"))
    exact = by_key.filter("__a = __b").selectExpr(*idents(keys), f"if(__a, '{EXTRA}', '{MISSING}') AS side")
    return union_all([told, exact])
