"""Near-duplicates by b-bit MinHash.

Each text's shingle set gets ``BANDS * ROWS`` minima. Bands of minima make
buckets; of every minimum two low bits are kept, packed into bit planes, and
the similarity of a candidate pair is estimated from the bits that agree,
corrected for those that agree by chance. What passes is confirmed on the full
sets, and confirmed links are closed into components.

Texts with equal sets are one class, so exact copies never meet as pairs. In a
bucket each class is tested against one class of the bucket, another one in
every band. Buckets that still hold several components are then searched for
links between these inside the task, large ones as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mix, shingle_hashes, signed, stored, word_hashes

BANDS, ROWS, BITS = 42, 6, 2
LANES = 4  # longs per bit plane
_draw = np.random.default_rng(20240229)
_FACTORS = _draw.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _draw.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_ROLL = _draw.integers(1, 1 << 63, ROWS, np.uint64) | np.uint64(1)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the lower-cased (A-Z) word shingles."""
    return shingle_hashes(word_hashes(text.encode("utf-8", "replace").lower()), size)


def minima(shingles: np.ndarray) -> np.ndarray:
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        values = short[at : at + 2048, None] * _FACTORS + _OFFSETS
        np.minimum(least, values.min(axis=0), out=least)
    return least


def planes(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, ``BITS`` planes of ``LANES`` longs."""
    padded = np.zeros(LANES * 64, np.uint32)
    padded[: len(least)] = least
    bits = [np.packbits((padded >> np.uint32(b)) & np.uint32(1)) for b in range(BITS)]
    return np.concatenate(bits).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of each row of ``a`` to the row of ``b``, from agreeing bits.

    Unequal minima agree in their low bits with chance ``2 ** -BITS``.
    """
    differ = a ^ b
    differ = differ[..., :LANES] | differ[..., LANES:]
    # Of a signed number, numpy would count the bits of its absolute value.
    unlike = np.bitwise_count(differ.view(np.uint64)).sum(axis=-1)
    agree = 1 - unlike / (BANDS * ROWS)
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


SIGNED = "n_shingles long, k1 long, k2 long, bands array<long>, bits array<long>"


def _signatures(size: int, kept: list[tuple[str, pa.DataType]]):
    arrow = pa.schema(
        [
            *kept,
            ("n_shingles", pa.int64()),
            ("k1", pa.int64()),
            ("k2", pa.int64()),
            ("bands", pa.list_(pa.int64())),
            ("bits", pa.list_(pa.int64())),
        ]
    )

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n = part.num_rows
            counts, k1, k2 = (np.zeros(n, np.int64) for _ in range(3))
            bands, bits = np.zeros((n, BANDS), np.int64), np.zeros((n, BITS * LANES), np.int64)
            for i, text in enumerate(part.column("text")):
                found = shingle_set(text.as_py() or "", size)
                counts[i] = len(found)
                if len(found):
                    k1[i] = np.int64(signed(np.sum(mix(found), keepdims=True))[0])
                    k2[i] = np.int64(signed(np.sum(mix(found ^ _OTHER), keepdims=True))[0])
                    least = minima(found)
                    rows = least.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
                    bands[i] = signed(mix((rows * _ROLL).sum(axis=1, dtype=np.uint64)))
                    bits[i] = planes(least)
            arrays = [part.column(name) for name, _ in kept]
            arrays += [pa.array(x) for x in (counts, k1, k2)]
            for values in (bands, bits):
                offsets = np.arange(n + 1, dtype=np.int32) * values.shape[1]
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel())))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return sign


def _segments(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with one key from a stream sorted by it, many runs at a time."""
    held = None
    for part in parts:
        table = pa.Table.from_batches([part])
        held = table if held is None else pa.concat_tables([held, table])
        keys = held.column(key).to_numpy()
        if not len(keys) or keys[0] == keys[-1]:
            continue
        whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        yield held.slice(0, whole)
        held = held.slice(whole)
    if held is not None and held.num_rows:
        yield held


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _overlaps(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``others`` shares with ``x``; all are sorted sets, none is empty."""
    values = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, values), len(x) - 1)] == values
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat(hit.astype(np.int64), starts)


def _across(floor: float, percent: int, some: int = 64):
    """Links between unlike components of one bucket, or of two blocks of one.

    Rows of side 0 meet all others, rows of a block those of the other block.
    Pairs are told by their estimates and confirmed on the sets where they
    stand, so only links leave the task. Two components that a link has joined
    are not compared any further.
    """
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _segments(parts, "bucket"):
            keys = table.column("bucket").to_numpy()
            ids, group = table.column("id").to_numpy(), table.column("component").to_numpy().copy()
            side = table.column("side").to_numpy()
            flat = table.column("bits").combine_chunks().flatten().to_numpy()
            bits = flat.reshape(len(ids), BITS * LANES)
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("found")]
            edges = np.flatnonzero(np.diff(keys, prepend=~keys[0], append=~keys[-1]))
            links = []
            for s, e in zip(edges[:-1], edges[1:]):
                here, sides = group[s:e], side[s:e]
                for i in range(e - s - 1):
                    unlike = here[i + 1 :] != here[i]
                    if sides[i]:
                        unlike &= sides[i + 1 :] != sides[i]
                    others = np.flatnonzero(unlike) + i + 1
                    likeness = estimate(bits[s + others], bits[s + i])
                    near = others[np.argsort(-likeness)][: np.count_nonzero(likeness >= floor)]
                    for at in range(0, len(near), some):
                        left = [j for j in near[at : at + some] if here[j] != here[i]]
                        if not left:
                            continue
                        x, found = sets[s + i], [sets[s + j] for j in left]
                        for j, y, both in zip(left, found, _overlaps(x, found)):
                            if here[i] != here[j] and 100 * both >= percent * (len(x) + len(y) - both):
                                links.append(sorted((ids[s + i], ids[s + j])))
                                here[here == here[j]] = here[i]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], schema=arrow)

    return search


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component`` (the smallest linked id) for every id with a link.

    Alternates large-star and small-star steps, which need about ``log n``
    rounds whatever the shape of the links. Each round is written, so a lost
    executor costs a part of one round. The driver sees two numbers a round.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).filter("v <> m").distinct()
    )
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % 1000003)).first())
        if state == before or not state[0]:
            return edges.select(F.col("v").alias("id"), F.col("m").alias("component")).union(
                edges.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct()
            )
        before = state
        both = edges.select("v", "m").union(edges.select("m", "v")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select("v", "m").distinct()
        smallest = large.groupBy("v").agg(F.min("m").alias("s"))
        small = large.join(smallest, "v").select("v", "m", "s")
        edges = stored(
            small.select(F.explode(F.expr("array(struct(v AS v, s AS m), struct(m AS v, s AS m))")).alias("e"))
            .select("e.v", "e.m")
            .filter("v <> m")
            .distinct()
        )


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 80,
    slack: float = 0.13,
    most: int = 1024,
) -> DataFrame:
    """The component of every document under links of ``percent`` similarity.

    Two texts are linked when ``100 * |A & B| >= percent * |A | B|`` for their
    sets of ``shingle``-word shingles (a shorter text counts as one shingle).
    Candidates share a band; of two texts with similarity 0.8 that fails once
    in 350,000 pairs. A candidate is dropped without confirmation only when its
    estimate is ``slack`` (four standard deviations) below the bound.

    Returns ``id_column``, ``n_shingles``, ``component_id`` (the smallest id in
    the component), ``kept`` (whether that is the row's own id), ``component``
    (its number; null without shingles) and ``text_hash`` (``xxhash64`` of the
    text), a row per input row. A null text or one without words has no shingles and no links.
    A null id counts as larger than any other. Rows with equal ids are separate
    documents; those with equal texts share a component. An empty table gives
    an empty result. Other columns are not looked at.
    """
    spark: SparkSession = docs.sparkSession
    # Texts are told apart by two hashes of their own, so that a class can be
    # found again in the table.
    read = docs.select(
        F.col(id_column).cast("long").alias("doc"),
        F.xxhash64(text_column).alias("t1"),
        F.xxhash64(F.lit("again"), F.col(text_column)).alias("t2"),
        F.col(text_column).alias("text"),
    )
    kept = [("doc", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64())]
    signed_rows = stored(read.mapInArrow(_signatures(shingle, kept), f"doc long, t1 long, t2 long, {SIGNED}"))

    same = ["k1", "k2", "n_shingles"]
    classes = stored(
        signed_rows.filter("n_shingles > 0")
        .groupBy(*same)
        .agg(
            F.min("doc").alias("low"),
            F.first(F.struct("t1", "t2", "bands", "bits")).alias("one"),
        )
        .select(F.monotonically_increasing_id().alias("id"), *same, "low", "one.*")
    )
    rows = classes.select("id", F.posexplode("bands").alias("band", "key")).select(
        "id", F.xxhash64("band", "key").alias("bucket")
    )
    # Xor with the bucket's own hash gives every bucket another order of ids.
    shared = stored(
        rows.groupBy("bucket")
        .agg(F.min(F.col("id").bitwiseXOR(F.col("bucket"))).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    members = stored(
        rows.join(shared, "bucket").select(
            "bucket", "id", F.col("first").bitwiseXOR(F.col("bucket")).alias("star"), "n"
        )
    )
    tested = stored(
        members.filter("id <> star")
        .select(F.least("id", "star").alias("a"), F.greatest("id", "star").alias("b"))
        .distinct()
    )
    floor = percent / 100 - slack
    likely = _estimated(tested, classes, floor)
    sets = stored(_whole_sets(members, classes, read, shingle))
    links = stored(_confirmed(likely, sets, percent))
    found = components(links)

    # Buckets of more than two classes may hold links their star has not tested.
    grouped = members.filter("n > 2").join(found, "id", "left").select(
        "bucket", "id", "star", "n", F.coalesce("component", "id").alias("component")
    )
    # Written, like what components are joined with below: an aggregate lies as its key
    # does, and Spark splits a hot key only where both sides come from a shuffle.
    mixed = stored(
        grouped.filter("id <> star")
        .groupBy("bucket")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x <> y")
        .select("bucket")
    )
    rest = stored(grouped.join(mixed, "bucket").select("bucket", "id", "n", "component"))
    searched = rest.filter(F.col("n") <= most).select("bucket", "id", "component", F.lit(0).alias("side"))
    more = stored(
        searched.unionByName(_block_pairs(rest.filter(F.col("n") > most), max(most // 2, 1)))
        .join(classes.select("id", "bits"), "id")
        .join(sets, "id")
        .select("bucket", "id", "component", "side", "bits", "found")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_across(floor, percent), "a long, b long")
        .distinct()
    )
    if not more.isEmpty():
        links = links.unionByName(more)
        found = components(links)

    placed = classes.join(found, "id", "left").select(
        *same, "low", F.coalesce("component", "id").alias("component")
    )
    lowest = stored(placed.groupBy("component").agg(F.min("low").alias("lowest")))
    placed = placed.join(lowest, "component").select(*same, "lowest", "component")
    joined = signed_rows.select("doc", "t1", *same).join(placed, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc"))
    return joined.select(
        F.col("doc").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
        "component",
        F.col("t1").alias("text_hash"),
    )


def _block_pairs(crowded: DataFrame, size: int) -> DataFrame:
    """``bucket, id, component, side``: large buckets as pairs of blocks, a bucket for each pair.

    ``crowded``: bucket, id, n, component. A component of more than ``size``
    members in a bucket has blocks of its own, which need not meet each other;
    the other members are dealt to blocks whatever their components are. Any
    two members of unlike components meet in one pair of blocks.
    """
    large = stored(
        crowded.groupBy("bucket", "component").agg(F.count("*").alias("held")).filter(F.col("held") > size)
    )
    own = large.groupBy("bucket").agg(F.sum("held").alias("owned"))
    # The other members have the owner -1.
    dealt = stored(
        crowded.join(large, ["bucket", "component"], "left")
        .join(own, "bucket", "left")
        .select(
            "bucket",
            "id",
            "component",
            F.when(F.col("held").isNotNull(), F.col("component")).otherwise(F.lit(-1)).alias("owner"),
            F.coalesce("held", F.col("n") - F.coalesce("owned", F.lit(0))).alias("held"),
        )
        .select(
            "bucket", "id", "component", "owner",
            F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / size)).alias("number"),
        )
    )
    blocks = stored(dealt.select("bucket", "owner", "number").distinct())
    one, two = blocks.alias("one"), blocks.alias("two")
    pairs = one.join(two, F.expr("one.bucket = two.bucket")).filter(
        """(one.owner = -1 AND two.owner = -1 AND one.number <= two.number) OR one.owner < two.owner"""
    )
    key = F.expr("xxhash64(one.bucket, one.owner, one.number, two.owner, two.number)")
    alone = F.expr("one.owner = two.owner AND one.number = two.number")
    sides = F.when(alone, F.expr("array(struct(one.owner, one.number, 0 AS side))")).otherwise(
        F.expr("array(struct(one.owner, one.number, 1 AS side), struct(two.owner, two.number, 2 AS side))")
    )
    placed = stored(
        pairs.select(F.col("one.bucket").alias("bucket"), key.alias("pair"), F.inline(sides))
    )
    return dealt.join(placed, ["bucket", "owner", "number"]).select(
        F.col("pair").alias("bucket"), "id", "component", "side"
    )


def rejected_copies(found: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """What must go so that one document of each component stays.

    From the result of ``near_duplicates``: the ``id, text_hash`` of all
    documents but one of each component, and of those that stay the ones that
    several equal rows hold, so that all but one of these can go.
    """
    rows = stored(
        found.groupBy(F.col(id_column).alias("id"), "text_hash", "component")
        .agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
        .filter("component IS NOT NULL")
    )
    chosen = rows.filter("kept").groupBy("component").agg(F.min("text_hash").alias("chosen"))
    judged = rows.join(chosen, "component").withColumn("stays", F.expr("kept AND text_hash = chosen"))
    gone = stored(judged.filter("NOT stays").select("id", "text_hash"))
    several = stored(judged.filter("stays AND n > 1").select("id", "text_hash"))
    return gone, several


def _estimated(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """Pairs whose bit planes agree well enough, counted in the engine."""
    bits = classes.select("id", "bits")
    met = (
        pairs.join(bits.toDF("a", "x"), "a")
        .join(bits.toDF("b", "y"), "b")
        .select("a", "b", "x", "y")
    )
    unlike = " + ".join(
        f"bit_count({' | '.join(f'(x[{p * LANES + i}] ^ y[{p * LANES + i}])' for p in range(BITS))})"
        for i in range(LANES)
    )
    chance = 2.0**-BITS
    agree = f"1 - ({unlike}) / {BANDS * ROWS}D"
    return met.filter(f"(({agree}) - {chance}D) / {1 - chance}D >= {floor}D").select("a", "b")


def _whole_sets(members: DataFrame, classes: DataFrame, read: DataFrame, shingle: int) -> DataFrame:
    """``id, found``: the full shingle set of every class that shares a bucket."""
    wanted = stored(members.select("id").distinct().join(classes.select("id", "t1", "t2"), "id"))
    # The wanted classes grow with the corpus, so they are never broadcast.
    texts = read.filter("text IS NOT NULL").join(wanted.hint("merge"), ["t1", "t2"]).select("id", "text")
    arrow = pa.schema([("id", pa.int64()), ("found", pa.binary())])

    def whole_sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            # Sets are larger than their texts, so they leave some at a time.
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                found = [shingle_set(t.as_py(), shingle).tobytes() for t in some.column("text")]
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(found, pa.binary())], schema=arrow)

    # Copies of one text give one set.
    return texts.mapInArrow(whole_sets, "id long, found binary").dropDuplicates(["id"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that are similar enough on their full sets."""
    met = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    linked = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sides = zip(part.column("x"), part.column("y"))
            good = [_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair), percent) for pair in sides]
            chosen = part.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], schema=linked)

    return met.mapInArrow(confirm, "a long, b long")
