"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards, which are scanned in turn, round and round.
Words are counted from the first scan on. A longer phrase becomes active as
soon as both phrases it has without its last and without its first word have
reached the threshold, and is counted until it has seen each shard once. So
lengths interleave: while words still complete their first cycle, pairs and
triples of the words that are frequent by then are counted in the same scans.

A scan is one job over one shard. Tasks read word runs off the bytes with
numpy, drop those that cannot be active by a bit filter of the frequent phrases
(of a fixed size, whatever the corpus holds), and add equal ones up. Until the
end a phrase is a 62-bit hash and a count, no text. A last scan then counts the
frequent ones once more by their text, so hashes that collide change nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import BASE, discard, mix, powers, prefix_hashes, shared_folder, stored

UNKNOWN = "und"
# The lowest bits of a phrase's hash are its number of words less one.
SIZE_BITS = 2
HASHED = "g long, a long"
NAMED = "lang string, size int, phrase string, a long"
_HASHED = pa.schema([("g", pa.int64()), ("a", pa.int64())])
_NAMED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])
# What a byte is: part of a word, a gap between words, the end of a piece.
_WORD, _GAP, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = _GAP
_KIND[[*b".,;:!?", *range(10, 14)]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
CHUNK = 1 << 19
# What a task is handed at once.
BATCH_BYTES = 4 << 20


class Filter:
    """Bits set by 64-bit hashes: says yes to all hashes it was given, and to few others."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.octets = np.zeros(1 << (bits - 3), np.uint8)

    def __getstate__(self) -> tuple[int, bytes]:
        # Sent to every task, and mostly empty while the corpus is small.
        return self.bits, zlib.compress(self.octets.tobytes(), 1)

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.bits = state[0]
        self.octets = np.frombuffer(zlib.decompress(state[1]), np.uint8)

    def shifts(self) -> list[int]:
        """A hash sets a bit for its upper, its middle and its lower bits."""
        return [64 - self.bits, (64 - self.bits) // 2, SIZE_BITS]

    def with_blocks(self, blocks: list) -> Filter:
        """A filter that also has the bits of ``blocks``, rows of ``bit_blocks``."""
        more = Filter(self.bits)
        more.octets[:] = self.octets
        for r in blocks:
            more.octets[r["block"] << 12 : (r["block"] + 1) << 12] |= np.frombuffer(r["bits"], np.uint8)
        return more

    def bit_blocks(self, phrases: DataFrame, *by: str) -> list:
        """The bits of the hashes ``g``, for each value of ``by``. The driver receives bits, never phrases."""
        places = ", ".join(f"shiftrightunsigned(g, {k}) & {(1 << self.bits) - 1}L" for k in self.shifts())
        return (
            phrases.select(*by, F.expr(f"explode(array({places}))").alias("at"))
            .groupBy(*by, F.expr("at DIV 32768").alias("block"))
            .agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits"))
            .collect()
        )

    def holds(self, g: np.ndarray) -> np.ndarray:
        found = np.ones(len(g), bool)
        for k in self.shifts():
            at = (g >> np.uint64(k)) & np.uint64((1 << self.bits) - 1)
            found &= (self.octets[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> pa.Array:
    """Phrases of ``size`` words each as strings, words joined by a space.

    ``starts`` and ``ends`` have ``size`` columns, the words' places in ``raw``.
    """
    lengths = ends - starts
    lengths[:, :-1] += 1  # the byte after a word, to become the space
    flat = lengths.ravel()
    out = np.concatenate(([0], np.cumsum(flat)))
    data = raw[np.arange(out[-1]) + np.repeat(starts.ravel() - out[:-1], flat)]
    inner = np.ones_like(lengths, bool)
    inner[:, -1] = False
    data[out[1:][inner.ravel()] - 1] = 32
    offsets = out[::size].astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))


def _chunks(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """``bytes, document ends, langs`` of documents of some ``CHUNK`` bytes together.

    A longer document comes in parts that end where a piece ends.
    """
    texts, langs = part.column("text"), part.column("lang").to_pylist()
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        held = data[offsets[at] : offsets[to]]
        if to == at + 1 and len(held) > CHUNK:
            stops = np.flatnonzero(_KIND[held] == _END) + 1
            begin = 0
            while begin < len(held):
                usable = stops[(stops > begin) & (stops <= begin + CHUNK)]
                later = stops[stops > begin + CHUNK]
                end = int(usable[-1]) if len(usable) else int(later[0]) if len(later) else len(held)
                yield held[begin:end], np.array([end - begin]), langs[at:to]
                begin = end
        else:
            yield held, offsets[at + 1 : to + 1] - offsets[at], langs[at:to]
        at = to


class _Words:
    """The words of some texts: where they are, their piece, their language, their hash."""

    def __init__(self, data: np.ndarray, doc_ends: np.ndarray, langs: list[str]) -> None:
        self.raw = raw = _LOWER[data]
        kind = _KIND[raw]
        word = kind == _WORD
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # A word ends with its document, though the next one may begin at once.
        cuts = np.unique(doc_ends[(doc_ends > 0) & (doc_ends < len(raw))])
        cuts = cuts[word[cuts - 1] & word[cuts]]
        self.starts = np.sort(np.concatenate((starts, cuts)))
        self.ends = np.sort(np.concatenate((ends, cuts)))
        doc = np.searchsorted(doc_ends, self.starts, "right")
        self.piece = np.cumsum(kind == _END)[self.starts] + doc
        self.names, code = np.unique(np.array(langs, object).astype(str), return_inverse=True)
        self.lang = code[doc]
        sums = prefix_hashes(raw)
        self.hash = _hashes(sums[self.ends] - sums[self.starts], self.starts, self.ends)
        seeds = [np.frombuffer(n.encode(), np.uint8) for n in self.names]
        seeds = [_hashes(prefix_hashes(n)[-1:], np.array([0]), np.array([len(n)]))[0] for n in seeds]
        # Mixed once more, so that a word is not told like the name of its language.
        self.seed = mix(np.array(seeds, np.uint64))[self.lang]

    def phrases(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words from the word numbers ``at`` on, by language."""
        total = np.zeros(len(at), np.uint64)
        for i in range(size):
            total = total * BASE + self.hash[at + i]
        return (mix(total ^ self.seed[at]) & ~np.uint64((1 << SIZE_BITS) - 1)) | np.uint64(size - 1)

    def longer(self, at: np.ndarray, good: np.ndarray, size: int) -> np.ndarray:
        """Where phrases of ``size`` words stand both whose parts are ``good``.

        ``at`` has the word numbers of the phrases that are a word shorter. The
        result has indices into it.
        """
        first = np.flatnonzero(good[:-1] & good[1:] & (at[1:] == at[:-1] + 1))
        return first[self.piece[at[first]] == self.piece[at[first] + size - 1]]

    def named(self, at: np.ndarray, g: np.ndarray, size: int) -> pa.RecordBatch:
        """Each phrase at the word numbers ``at``, with hashes ``g``, as text, and how often it is there."""
        _, where, counts = np.unique(g, return_index=True, return_counts=True)
        spots = at[where, None] + np.arange(size)
        arrays = [
            pa.array(self.names.astype(object)[self.lang[at[where]]], pa.string()),
            pa.array(np.full(len(where), size, np.int32)),
            _slices(self.raw, self.starts[spots], self.ends[spots], size),
            pa.array(counts.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=_NAMED)


def _added(g: np.ndarray, some: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Each hash once and how often it is there, ``some`` at a time."""
    kinds, counts = np.unique(g, return_counts=True)
    for at in range(0, len(kinds), some):
        columns = kinds[at : at + some].view(np.int64), counts[at : at + some].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_HASHED)


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(sums * powers(int(starts.max(initial=0)) + 1)[starts] + (ends - starts).astype(np.uint64))


def _scan(longest: int, with_words: bool, known: Filter, old: Filter):
    """Hashes and counts of the active phrases of a shard's texts, chunk by chunk.

    Words are active in the first cycle. A longer phrase is active if both
    phrases it has without an outer word are ``known`` as frequent, and were not
    both known a cycle ago (``old``).
    """

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            active: list[np.ndarray] = []
            for chunk in _chunks(part):
                words = _Words(*chunk)
                # Word numbers where a phrase of the size below stands, and what is known of it.
                at = np.arange(len(words.starts))
                g = words.phrases(at, 1)
                active += [g] if with_words else []
                for size in range(2, longest + 1):
                    good = known.holds(g)
                    at, new = at[good], ~old.holds(g[good])
                    first = words.longer(at, np.ones(len(at), bool), size)
                    at, new = at[first], new[first] | new[first + 1]
                    g = words.phrases(at, size)
                    active.append(g[new])
            # What a batch holds is added up here, and costs the shuffle a row each.
            if active:
                yield from _added(np.concatenate(active))

    return scan


def _name(longest: int, known: Filter):
    """The phrases that are ``known`` as text, with their counts; the number of all words as of size 0."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in _chunks(part):
                words = _Words(*chunk)
                totals = np.bincount(words.lang, minlength=len(words.names)).astype(np.int64)
                none = pa.array([""] * len(totals))
                zero = pa.array(np.zeros(len(totals), np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(words.names.astype(object)), zero, none, pa.array(totals)], schema=_NAMED)
                at = np.arange(len(words.starts))
                for size in range(1, longest + 1):
                    if size > 1:
                        at = at[words.longer(at, np.ones(len(at), bool), size)]
                    g = words.phrases(at, size)
                    good = known.holds(g)
                    at, g = at[good], g[good]
                    if len(at):
                        yield words.named(at, g, size)

    return scan


def phrase_counts(
    docs: DataFrame,
    *,
    lang_column: str = "lang",
    text_column: str = "text",
    least: int = 30,
    longest: int = 4,
    shards: int = 4,
    filter_bits: int = 25,
) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, a`` of all phrases of up to ``longest`` words found ``least`` times, and ``lang, n``.

    Exact: a phrase that often has both its parts that often, so it becomes
    active, and it is then counted in each shard once. A filter that says yes
    too often, or two phrases of one hash, only activate a phrase earlier or in
    vain; the counts returned are those of the texts themselves. ``n`` counts
    all words. ``longest`` is 4 at most.

    Inside a chunk of a task (half a MB) phrases are told apart by their hashes alone.
    """
    if not 1 <= longest <= 1 << SIZE_BITS:
        raise ValueError(f"phrases of 1 to {1 << SIZE_BITS} words, not {longest}")
    spark = docs.sparkSession
    path = shared_folder(spark)
    dealt = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"),
    )
    dealt.write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)

    filters = [Filter(filter_bits)]  # of what is frequent after each scan
    state, held = spark.createDataFrame([], f"{HASHED}, started int"), None
    frequent, step = Filter(filter_bits), 0
    while True:
        known, old = filters[-1], filters[max(0, len(filters) - 1 - shards)]
        texts = dealt.filter(F.col("shard") == step % shards).select("lang", "text")
        seen = texts.mapInArrow(_scan(longest, step < shards, known, old), HASHED).withColumn("started", F.lit(step))
        # What was first seen a cycle ago has been in each shard.
        going = state.filter(F.col("started") + shards > step)
        summed = seen.unionByName(going).groupBy("g").agg(F.sum("a").alias("a"), F.min("started").alias("started"))
        before, held = held, shared_folder(spark)
        state = stored(summed, BATCH_BYTES, held)
        if before:
            discard(spark, before)
        # Both filters out of one look at the counts: the longest phrases make no longer ones active.
        short = F.col("g").bitwiseAND((1 << SIZE_BITS) - 1) < longest - 1
        blocks = known.bit_blocks(state.filter(F.col("a") >= least).select("g", short.alias("short")), "short")
        frequent = frequent.with_blocks(blocks)
        filters.append(known.with_blocks([r for r in blocks if r["short"]]))
        if step >= shards - 1 and np.array_equal(filters[-1].octets, filters[-1 - shards].octets):
            break  # no phrase can become active
        filters[: -1 - shards] = []
        step += 1
    discard(spark, held)
    named = (
        dealt.select("lang", "text")
        .mapInArrow(_name(longest, frequent), NAMED)
        .groupBy("lang", "size", "phrase")
        .agg(F.sum("a").alias("a"))
        .filter((F.col("a") >= least) | (F.col("size") == 0))
    )
    named = stored(named, BATCH_BYTES)
    totals = named.filter("size = 0 AND a > 0").select("lang", F.col("a").alias("n"))
    return named.filter("size > 0"), totals


def collocations(
    docs: DataFrame,
    *,
    lang_column: str = "lang",
    text_column: str = "text",
    least: int = 30,
    longest: int = 4,
    first: int = 2000,
    covered: int = 80,
    **scans: int,
) -> DataFrame:
    """The ``first`` best phrases of two to ``longest`` words of each language.

    A text has A-Z in lower case and is cut into pieces at ``. , ; : ! ?`` and
    line ends, these into words at spaces and tabs; phrases lie within a piece.
    A phrase found ``least`` times is a candidate. Cut in two, it scores
    ``floor(2000000 * a / (l + r))`` for its own and its parts' counts, and its
    lowest score holds. A candidate goes when a longer one around it has
    ``covered`` percent of its occurrences.

    Returns ``lang, rank, phrase, a, l, r, n, score``, best score first, then
    most frequent, then by the phrase's bytes. A null language is ``und``, a null or empty text
    has no words; equal rows count each. An empty table gives an empty result.
    Other columns are not looked at.
    """
    counts, totals = phrase_counts(
        docs, lang_column=lang_column, text_column=text_column, least=least, longest=longest, **scans
    )
    candidates = counts.filter("size >= 2")
    parts = counts.select("lang", "phrase", "a")

    # Every way to cut a candidate; both parts are as frequent, so they are known.
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("tail"),
    )
    heads, tails = parts.toDF("lang", "head", "l"), parts.toDF("lang", "tail", "r")
    # Decimals hold the product of any two counts.
    score = F.expr("CAST(CAST(a AS DECIMAL(20, 0)) * 2000000 DIV (CAST(l AS DECIMAL(20, 0)) + r) AS LONG)")
    scored = (
        cut.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )

    # The most frequent longer candidate around each phrase.
    inside = F.expr(
        "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m),"
        " i -> array_join(slice(split(phrase, ' ', -1), i + 1, m), ' ')))))"
    )
    around = (
        candidates.filter("size >= 3")
        .select("lang", inside.alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("most"))
    )
    enough = f"most IS NULL OR 100 * CAST(most AS DECIMAL(20, 0)) < {covered} * CAST(a AS DECIMAL(20, 0))"
    left = stored(scored.join(around, ["lang", "phrase"], "left").filter(enough).drop("most"))

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # In parts first, so that no task has all candidates of a language.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*best)
    likely = left.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= first)
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    ranked = likely.withColumn("rank", ranks).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
