"""What several operators need: intermediate tables, words, hashes."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors reach.

    It lies below ``spark.checkpoint.dir``, or below the warehouse where that
    is unset. ``drop_scratch`` removes it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(rows: DataFrame, batch_bytes: int = 8 << 20, path: str | None = None) -> DataFrame:
    """``rows`` as a written table: computed once, its size known to the planner.

    A lost executor costs only the tasks that read it again. While it is
    written, Python tasks get batches of at most ``batch_bytes``: beside a full
    heap there is little room for Arrow's buffers. The setting is put back. With
    a ``path`` from ``shared_folder``, ``discard`` can remove the table again.
    """
    spark = rows.sparkSession
    path = path or shared_folder(spark)
    before = spark.conf.get(ARROW_BATCH)
    spark.conf.set(ARROW_BATCH, str(batch_bytes))
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(ARROW_BATCH, before)
    return spark.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that no frame reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch() -> None:
    """Remove what ``stored`` has written; frames that read it are then void."""
    while _made:
        spark, path = _made.pop()
        try:
            discard(spark, path)
        except Exception:  # noqa: BLE001  the session has ended, and its folder with it
            pass


atexit.register(drop_scratch)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # translate() looks at every character, lower() of plain ASCII does not.
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a lower-cased text; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(parts, "")


# Hashes of words and shingles, vectorised over the bytes of a text. All are
# functions of the bytes alone, so they agree on every executor and in every run.

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the output."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``BASE ** i`` or its inverse for ``i < n``, modulo 2**64; kept between calls."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), _INVERSE if inverse else BASE, np.uint64)
        steps[0] = 1
        _powers[inverse] = have = np.multiply.accumulate(steps)
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes: entry ``i`` covers ``data[:i]``.

    ``(p[e] - p[s]) * BASE ** s`` depends only on ``data[s:e]``, so substrings
    compare in constant time.
    """
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), True), out=out[1:])
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each ``[^\\x20\\x09-\\x0D]+`` of ``data``, in order."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    word = ~_SPACE[raw]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = prefix_hashes(raw)
    return mix((sums[ends] - sums[starts]) * powers(len(raw))[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words, sorted; of a shorter text, of all its words."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = total * BASE + words[i : len(words) - size + 1 + i]
    return np.unique(mix(total))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def batches(rows: Iterable, size: int):
    """Lists of at most ``size`` of ``rows``."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held
