"""Bottom-k sketches of word shingles as document fingerprints.

A sketch holds the ``k`` smallest 64-bit hashes of a text's distinct shingles.
Sketches of parts merge into the sketch of the whole, and two sketches
estimate resemblance, containment and the number of distinct shingles. A set
of at most ``k`` shingles is held in full and compares exactly.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import shingle_hashes, word_hashes

K = 128
SHINGLE = 5


def sketch(text: str | None, k: int = K, size: int = SHINGLE) -> np.ndarray:
    """The ``k`` smallest shingle hashes; empty for a text without words."""
    words = word_hashes((text or "").encode("utf-8", "replace"))
    return shingle_hashes(words, size)[:k]


def pack(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u8").tobytes()).decode()


def unpack(packed: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(packed), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of both shingle sets."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated ``|A & B| / |A | B|``; of two empty sets 1."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float((both <= union[-1]).sum() / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of A's shingles that are in B; of an empty A 1."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


def fingerprint_texts(docs: DataFrame, text_column: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the packed sketch of each text; a null text counts as empty."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack(sketch(t)))

    return docs.withColumn(into, of(F.coalesce(F.col(text_column), F.lit(""))))


def merge_by(parts: DataFrame, keys: list[str], column: str = "fingerprint", salts: int = 64) -> DataFrame:
    """One sketch per group of ``keys``, merged from its parts' sketches.

    Every part gives at most ``k`` hashes, and a group meets in two steps: a
    hot group is first merged in ``salts`` places.
    """

    @F.pandas_udf("string")
    def merged(values: pd.Series) -> str:
        found = np.zeros(0, np.uint64)
        for value in values.dropna():
            found = merge(found, unpack(value))
        return pack(found)

    salted = parts.withColumn("__salt", F.pmod(F.xxhash64(column), F.lit(salts)))
    # Equal sketches merge to themselves, so one of each is enough.
    once = salted.groupBy(*keys, "__salt", column).count()
    some = once.groupBy(*keys, "__salt").agg(merged(F.col(column)).alias(column))
    return some.groupBy(*keys).agg(merged(F.col(column)).alias(column))


EDITED = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def edit_tail(text: str, other: str, part: int = 4) -> str:
    """``text`` with its last ``1/part`` replaced by as much of the head of ``other``."""
    cut = len(text) // part
    return text[: len(text) - cut] + other[:cut]


def compare_with_edits(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they are.

    The edited text ends in the head of the next document by id; the last is
    followed by the first. Texts are shuffled once, into ranges of ids
    (``buckets`` of them, by default ``spark.sql.shuffle.partitions``); the
    first document of a range is also sent to the end of the range before. The
    driver sees one id per range.

    A null text counts as empty. Null ids come last; equal ids are ordered by
    their texts. Repeated rows each count as a document. A single document is
    followed by itself; an empty table gives an empty result. Other columns are
    not looked at.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType
    ranged = rows.filter("id IS NOT NULL").select("id").repartitionByRange(buckets, "id")
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("id").alias("id"))
    starts = sorted(r["id"] for r in firsts.select("id").collect())
    last = max(len(starts) - 1, 0)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids, "right") - 1).astype("int32")

    place = "named_struct('bucket', {}, 'borrowed', {})"
    if starts:
        first = F.lit(starts[0]).cast(id_type)
        rows = rows.withColumn("at", F.when(F.isnull("id"), F.lit(last)).otherwise(range_of(F.coalesce("id", first))))
        start = F.get(F.array(*[F.lit(s).cast(id_type) for s in starts]), F.col("at"))
        before = f"if(at = 0, {last}, at - 1)"
        twice = F.expr(f"array({place.format('at', 'false')}, {place.format(before, 'true')})")
        places = F.when(F.col("id") == start, twice).otherwise(F.expr(f"array({place.format('at', 'false')})"))
    else:
        places = F.expr(f"array({place.format(0, 'false')}, {place.format(0, 'true')})")

    # Borrowed rows come last in their bucket; of several with one id the first counts.
    order = ["bucket", "borrowed", F.col("id").asc_nulls_last(), F.xxhash64("text"), "text"]
    laid = (
        rows.select("id", "text", F.inline(places))
        .repartition(buckets, "bucket")
        .sortWithinPartitions(*order)
    )

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            out = []
            columns = [part.column(c).to_pylist() for c in ("id", "text", "bucket", "borrowed")]
            for key, text, bucket, borrowed in zip(*columns):
                own = sketch(text)
                if held is not None and held[2] == bucket and not held[4]:
                    out.append(_compare(*held[:2], held[3], text, own))
                held = (key, text, bucket, own, borrowed)
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    fields = [f.split() for f in EDITED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = pa.schema(
        [("id", to_arrow_type(id_type)), *[(name, kinds[kind]) for name, kind in fields]]
    )
    schema = f"id {id_type.simpleString()}, {EDITED}"
    return laid.mapInArrow(compared, schema).withColumnRenamed("id", id_column)


def _compare(key, text: str, own: np.ndarray, other: str, others: np.ndarray) -> dict:
    changed = edit_tail(text, other)
    now = sketch(changed) if changed != text else own
    return {
        "id": key,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
        "fingerprint": pack(own),
        "edited_fingerprint": pack(now),
        "near_edited": resemblance(own, now),
        "near_next": resemblance(own, others),
    }
