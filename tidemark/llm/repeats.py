"""Removal of long repeated byte strings by a hash-compared suffix sort.

Every string of ``length`` bytes names one anchor inside itself: of its grams
the one with the smallest hash, which depends on the string alone. So equal
strings have equal anchors at equal offsets, and it is enough to compare
occurrences of one anchor gram. These are found by counting grams over the
corpus. Occurrences whose whole surroundings are alike are settled by that
count. Of the others, one of each kind is taken with its surroundings, and the
suffixes from the anchor on, and the reversed prefixes before it, are sorted:
a mergesort whose comparisons find the common extension by binary search over
polynomial prefix hashes, and whose result is verified byte by byte. Two
strings at one offset are equal when both their parts share a stretch of the
sorted orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mix, powers, prefix_hashes, signed, stored

LENGTH, GRAM = 200, 40
_LOW = np.uint64((1 << 21) - 1)
_CHUNK = 1 << 19
_ODD = np.uint64(0xD1B54A32D192ED03)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from block-wise running minima."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``hash, around, anchor, first, last`` for each run of strings with one anchor.

    The strings that start from ``first`` to ``last`` have their anchor at
    ``anchor``; ``hash`` is of the gram there, ``around`` of all they cover.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(len(raw) - length + 1, 0), _CHUNK):
        piece = raw[at : at + _CHUNK + length - 1]
        sums, scale = prefix_hashes(piece), powers(len(piece) + 1)
        grams = mix((sums[gram:] - sums[:-gram]) * scale[: len(piece) - gram + 1])
        # Of equal hashes the last one counts.
        ranked = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        least = _sliding_least(ranked, length - gram + 1)
        chosen = (_LOW - (least & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        last = np.append(first[1:], len(chosen)) - 1
        anchor = chosen[first]
        around = (sums[last + length] - sums[first]) * scale[first]
        shape = ((anchor - first) * 1024 + (last - first)).astype(np.uint64)
        found.append((grams[anchor], mix(around + shape * _ODD), anchor + at, first + at, last + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


# A place packs the anchor, how far before it the first string starts, and how
# many strings there are after that.


def _place(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (anchor << 20) | ((anchor - first) << 10) | (last - first)


class Suffixes:
    """Byte strings of at most ``width``, compared through prefix hashes."""

    def __init__(self, strings: list[bytes], width: int):
        self.symbols = np.zeros((len(strings), width + 1), np.uint16)
        for i, string in enumerate(strings):
            # 0 stands behind the end, so that a prefix comes first.
            self.symbols[i, : len(string)] = np.frombuffer(string, np.uint8).astype(np.uint16) + 1
        scaled = self.symbols[:, :width].astype(np.uint64) * powers(width)
        self.sums = np.zeros((len(strings), width + 1), np.uint64)
        np.cumsum(mix(scaled + np.arange(width, dtype=np.uint64) * _ODD), axis=1, out=self.sums[:, 1:])
        self.width = width

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) // 2
            same = self.sums[a, middle] == self.sums[b, middle]
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as ``a`` sorts before, with or behind ``b``."""
        at = self.common(a, b)
        x, y = self.symbols[a, at].astype(np.int64), self.symbols[b, at].astype(np.int64)
        return np.sign(x - y)

    def sort(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mergesort of every group, all groups at once: order, and the common
        extension of each string with the one before it (-1 for a group's first).
        """
        n = len(self.symbols)
        order = np.arange(n)
        self._new_group = np.isin(order, starts)
        base, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        inside = np.arange(n) - base
        width = 1
        while width < sizes.max(initial=0):
            run = inside // width
            pair = base + (run // 2) * 2 * width
            low = np.minimum(base + (run ^ 1) * width, base + size)
            high = np.minimum(low + width, base + size)
            begin = low.copy()
            # Equal strings of the left run stay before those of the right.
            wins = np.where(run % 2 == 0, 0, 1)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                less = self.before(order[middle], order[open_]) < wins[open_]
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            moved = np.empty_like(order)
            moved[pair + inside - run * width + (low - begin)] = order
            # A run without a partner stays where it is.
            order, width = moved, width * 2
        shared = np.full(n, -1)
        if n > 1:
            shared[1:] = self.common(order[:-1], order[1:])
            if not self._verified(order, shared):
                # Hashes of unlike strings collided: sort the bytes themselves.
                order = np.lexsort([*self.symbols.T[::-1], base])
                shared[1:] = self._extensions(order)
        shared[starts] = -1
        return order, shared

    def _extensions(self, order: np.ndarray) -> np.ndarray:
        """Common extensions of neighbours, on the bytes themselves."""
        a, b = self.symbols[order[:-1], : self.width], self.symbols[order[1:], : self.width]
        differ = a != b
        return np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)

    def _verified(self, order: np.ndarray, shared: np.ndarray) -> bool:
        """Whether the common extensions hold on the bytes, which settles the order too.

        A collision anywhere in the sort shows up between neighbours: either
        their extension is wrong, or they are out of order.
        """
        true = self._extensions(order)
        at = np.arange(len(order) - 1)
        ordered = self.symbols[order[at], true] <= self.symbols[order[at + 1], true]
        return bool((true == shared[1:]).all() and (ordered | self._new_group[1:]).all())


def repeated_offsets(
    group: np.ndarray, strings: list[bytes], anchor: np.ndarray, count: np.ndarray, length: int
) -> list[np.ndarray]:
    """For each string, the offsets of its parts of ``length`` that another string of its group has.

    Strings are aligned at ``anchor``; ``count`` parts start from 0 on. Groups
    lie together.
    """
    n = len(strings)
    starts = np.flatnonzero(np.diff(group, prepend=~group[0]))
    sizes = np.diff(np.append(starts, n))
    right = Suffixes([s[a:] for s, a in zip(strings, anchor)], length)
    left = Suffixes([s[:a][::-1] for s, a in zip(strings, anchor)], length)
    right_order, right_shared = right.sort(starts, sizes)
    left_order, left_shared = left.sort(starts, sizes)
    found = np.zeros((n, length), bool)
    for back in range(length):
        # Parts that start ``back`` bytes before the anchor.
        at = anchor - back
        active = np.flatnonzero((at >= 0) & (at < count))
        if not len(active):
            continue
        ahead_class, back_class = np.empty(n, np.int64), np.empty(n, np.int64)
        ahead_class[right_order] = np.cumsum(right_shared < length - back)
        back_class[left_order] = np.cumsum(left_shared < back)
        both = ahead_class[active] * (n + 1) + back_class[active]
        _, which, times = np.unique(both, return_inverse=True, return_counts=True)
        hit = active[times[which] > 1]
        found[hit, at[hit]] = True
    return [np.flatnonzero(row) for row in found]


def _ranges(values: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as first and last."""
    cuts = np.flatnonzero(np.diff(values) > 1)
    return list(zip(values[np.append(0, cuts + 1)].tolist(), values[np.append(cuts, len(values) - 1)].tolist()))


_RANGES = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
RANGES = "array<struct<lo:bigint,hi:bigint>>"


def _raw(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer() or b"", np.uint8)


def _anchor_rows(length: int, gram: int):
    schema = pa.schema([(c, pa.int64()) for c in ("hash", "around", "key", "place")])

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held, rows = [], 0
            for key, text in zip(part.column("key").to_numpy(), part.column("text")):
                h, c, anchor, first, last = anchors(_raw(text), length, gram)
                held.append((signed(h), signed(c), np.full(len(h), key), _place(anchor, first, last)))
                rows += len(h)
                if rows > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], schema=schema)
                    held, rows = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], schema=schema)

    return find


def _surroundings(length: int):
    schema = pa.schema(
        [("hash", pa.int64()), ("around", pa.int64()), ("anchor", pa.int64()), ("count", pa.int64()), ("bytes", pa.binary())]
    )

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            out: list[list] = [[], [], [], [], []]
            size = 0
            for packed, places in zip(part.column("packed"), part.column("places")):
                raw = unpack.decompress(packed.as_py())
                for p in places.as_py():
                    anchor, before, more = p["place"] >> 20, (p["place"] >> 10) & 1023, p["place"] & 1023
                    first = anchor - before
                    row = (p["hash"], p["around"], before, more + 1, raw[first : first + more + length])
                    for column, value in zip(out, row):
                        column.append(value)
                    size += more + length
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)
                        out, size = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    return cut


def _sorted_groups(length: int, batch: int = 4096):
    schema = pa.schema([("hash", pa.int64()), ("around", pa.int64()), ("starts", _RANGES)])

    def settle(table: pa.Table) -> pa.RecordBatch:
        found = repeated_offsets(
            table.column("hash").to_numpy(),
            [b.as_py() for b in table.column("bytes")],
            table.column("anchor").to_numpy(),
            table.column("count").to_numpy(),
            length,
        )
        some = np.array([len(f) > 0 for f in found])
        ranges = [[{"lo": lo, "hi": hi} for lo, hi in _ranges(f)] for f in found if len(f)]
        kept = table.filter(pa.array(some))
        columns = [kept.column(c).combine_chunks() for c in ("hash", "around")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(ranges, _RANGES)], schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for part in parts:
            for at in range(0, part.num_rows, batch):
                table = pa.Table.from_batches([part.slice(at, batch)])
                held = table if held is None else pa.concat_tables([held, table])
                keys = held.column("hash").to_numpy()
                if len(keys) < batch or keys[0] == keys[-1]:
                    continue
                whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
                yield settle(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield settle(held)

    return run


def _every_string(length: int):
    schema = pa.schema([(c, pa.int64()) for c in ("hash", "around", "back", "start", "string")])

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [part.column(c).to_numpy() for c in ("hash", "around", "anchor", "count")]
            for h, c, anchor, count, text in zip(*columns, part.column("bytes")):
                raw = _raw(text)
                sums = prefix_hashes(raw)
                at = np.arange(count)
                strings = mix((sums[at + length] - sums[at]) * powers(len(raw))[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, h)), pa.array(np.full(count, c)), pa.array(anchor - at), pa.array(at), pa.array(signed(strings))],
                    schema=schema,
                )

    return spread


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    most: int = 16384,
) -> DataFrame:
    """Every text without the bytes that a repeated string of ``length`` bytes covers.

    A string is repeated when it starts at another place of the corpus too, be
    it in the same text; overlaps count, and no string crosses texts. Returns
    ``id_column``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and ``kept`` (the bytes left), a row per input row.

    A gram with more than ``most`` kinds of surroundings is settled string by
    string in a distributed count, any other one by sorting in one task.

    A null text counts as empty; a text shorter than ``length`` loses nothing.
    Texts are UTF-8 bytes. Null and repeated ids are kept, every row being a
    text of its own, so repeated rows lose all of a long text. An empty table
    gives an empty result. Other columns are not looked at. Texts are told
    apart by 64-bit hashes.
    """
    texts = docs.select(
        F.col(id_column).alias("doc"),
        F.coalesce(text_column, F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(text_column, F.lit(""))).alias("key"),
    )
    long_enough = texts.filter(F.octet_length("text") >= length).select("key", "text")
    found = long_enough.mapInArrow(_anchor_rows(length, gram), "hash long, around long, key long, place long")

    # Grams that stand in two places or more, and whether all surroundings are alike.
    counts = stored(
        found.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min("around").alias("x"), F.max("around").alias("y"))
        .filter("n > 1")
        .select("hash", (F.col("x") == F.col("y")).alias("alike"))
    )
    several = stored(found.join(counts, "hash"))
    unlike = several.filter("NOT alike").drop("alike")
    kinds = (
        unlike.groupBy("hash", "around")
        .agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one"))
    )
    kinds = stored(kinds)
    wanted = stored(
        kinds.select("hash", "around", "one.*")
        .groupBy("key")
        .agg(F.collect_list(F.struct("hash", "around", "place")).alias("places"))
    )

    # Texts travel compressed.
    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in parts:
            packed = [squeeze.compress(t.as_buffer()) for t in part.column("text")]
            arrays = [part.column(c) for c in schema_of(part)] + [pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*schema_of(part), "packed"])

    def schema_of(part: pa.RecordBatch) -> list[str]:
        return [c for c in part.schema.names if c != "text"]

    once = long_enough.mapInArrow(pack, "key long, packed binary")
    around = stored(
        once.join(wanted, "key")
        .mapInArrow(_surroundings(length), "hash long, around long, anchor long, count long, bytes binary")
        .dropDuplicates(["hash", "around"])
    )
    sizes = around.groupBy("hash").agg(F.count("*").alias("m"))
    sized = around.join(sizes, "hash")
    settled = (
        sized.filter(F.col("m") <= most)
        .drop("m")
        .repartition("hash")
        .sortWithinPartitions("hash")
        .mapInArrow(_sorted_groups(length), f"hash long, around long, starts {RANGES}")
    )
    strings = sized.filter(F.col("m") > most).drop("m").mapInArrow(
        _every_string(length), "hash long, around long, back long, start long, string long"
    )
    same = ["hash", "back", "string"]
    twice = strings.groupBy(*same).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    by_string = (
        strings.join(twice, same)
        .groupBy("hash", "around")
        .agg(F.collect_list(F.struct(F.col("start").alias("lo"), F.col("start").alias("hi"))).alias("starts"))
    )
    partly = settled.unionByName(by_string)

    before, more = F.expr("shiftright(place, 10) & 1023"), F.expr("place & 1023")
    first = F.shiftright("place", 20) - before
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), more.alias("hi")))
    verdicts = stored(
        kinds.select("hash", "around", "n")
        .join(partly, ["hash", "around"], "left")
        .filter("n > 1 OR starts IS NOT NULL")
        .select("hash", "around", F.when(F.col("n") == 1, F.col("starts")).alias("starts"))
    )
    ranges = several.filter("alike").select("key", first.alias("first"), whole.alias("starts")).unionByName(
        unlike.join(verdicts, ["hash", "around"]).select(
            "key", first.alias("first"), F.coalesce("starts", whole).alias("starts")
        )
    )
    cover = ranges.select("key", "first", F.inline("starts")).select(
        "key", (F.col("first") + F.col("lo")).alias("from"), (F.col("first") + F.col("hi") + length).alias("to")
    )
    covered = stored(
        cover.distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))
    )

    doc_type = texts.schema["doc"].dataType.simpleString()
    travelling = texts.select("doc", "key", "text").mapInArrow(pack, f"doc {doc_type}, key long, packed binary")
    results = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]

    def strip(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            # Texts unfold to several times their size, so they leave some at a time.
            for at in range(0, part.num_rows, 512):
                some, out = part.slice(at, 512), []
                for packed, runs in zip(some.column("packed"), some.column("runs")):
                    raw = unpack.decompress(packed.as_py())
                    gone = np.zeros(len(raw) + 2, np.int8)
                    for run in runs.as_py() or ():
                        gone[run["from"] + 1 : run["to"] + 1] = 1
                    kept = np.frombuffer(raw, np.uint8)[gone[1:-1] == 0].tobytes()
                    spans = int((np.diff(gone) == 1).sum())
                    out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*out), results)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc"), *columns], names=["doc", *[name for name, _ in results]]
                )

    return (
        travelling.join(covered, "key", "left")
        .select("doc", "packed", "runs")
        .mapInArrow(strip, f"doc {doc_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        .withColumnRenamed("doc", id_column)
    )
