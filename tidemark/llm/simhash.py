"""Near-duplicates by SimHash, with links found by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits of each other have a value in the middle
that is within half the radius of both. So every distinct fingerprint emits all
values in its ball of half the radius, the values are shuffled, and
fingerprints that meet at a value are paired with the smallest one there. All
that meet are within ``radius`` of each other, so these pairs join just what
all pairs would join. A value is met by no more fingerprints than its own ball
holds (65 for radius 2), however many documents there are: no group grows with
the corpus, and exact copies are one fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .neardup import components
from .shared import stored

BITS = 64


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, repeats included.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. Fewer
    words than ``size`` are one run, no words are none.
    """
    words = text.lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    runs = zip(starts, ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in runs), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray, some: int = 1 << 15) -> np.uint64:
    """A bit is 1 if it is in over half of ``hashes``; without any, all are 0."""
    held = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), some):
        bits = np.unpackbits(hashes[at : at + some].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        held += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * held > len(hashes)).view(">u8").astype(np.uint64)[0]


def fingerprints(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """``doc, print``: the id and the signed fingerprint of every row of ``docs``.

    A null text has no words; without words the fingerprint is zero.
    """
    arrow = pa.schema([("doc", pa.int64()), ("print", pa.int64())])

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = np.zeros(part.num_rows, np.uint64)
            for i, text in enumerate(part.column("text")):
                found[i] = fingerprint(shingle_hashes(text.as_py() or b"", shingle))
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(found.view(np.int64))], schema=arrow)

    read = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("binary").alias("text"))
    return read.mapInArrow(sign, "doc long, print long")


def ball(radius: int) -> list[int]:
    """All masks of at most ``radius`` bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``a, b``: pairs of the distinct values ``print`` that connect all within ``radius`` bits.

    Not all such pairs, but pairs that connect the same values. ``radius`` is
    even; a ball of half of it has 1, 65 or 2,081 values for 0, 2 and 4.
    """
    if radius % 2 or not 0 <= radius <= 4:
        raise ValueError(f"radius {radius} is not 0, 2 or 4")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius // 2)])
    emitted = prints.select("print", F.explode(masks).alias("mask")).select(
        F.col("print").bitwiseXOR(F.col("mask")).alias("middle"), "print"
    )
    met = emitted.select("print", F.min("print").over(Window.partitionBy("middle")).alias("least"))
    pairs = met.filter("print <> least").distinct()
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("least"))) <= radius
    return pairs.filter(near).select(F.col("least").alias("a"), F.col("print").alias("b"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """The fingerprint and component of every document.

    Fingerprints link at ``radius`` or fewer differing bits. Returns
    ``id_column``, ``print`` (signed) and ``component_id``, the smallest id in
    the component, a row per input row. Null, empty and blank texts have the
    fingerprint zero and are linked like any other. A null id counts as larger
    than any other, so a component without any id has a null ``component_id``.
    Rows with equal ids are separate documents. An empty table gives an empty
    result. Other columns are not looked at.
    """
    signed = stored(fingerprints(docs, id_column=id_column, text_column=text_column, shingle=shingle))
    classes = stored(signed.groupBy("print").agg(F.min("doc").alias("low")))
    linked = components(stored(links(classes.select("print"), radius))).toDF("print", "component")
    placed = classes.join(linked, "print", "left").withColumn("component", F.coalesce("component", "print"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    # Both sides are tables as written, so that the join can split a hot fingerprint.
    named = stored(placed.join(lowest, "component").select("print", "component_id"))
    return signed.join(named, "print").select(F.col("doc").alias(id_column), "print", "component_id")
