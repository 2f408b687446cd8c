"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree of the groups' roots.

All levels are built by windows. A level numbers its nodes from 0; every ``fan``
consecutive ones are a run. Lag and lead columns of all offsets below ``fan``,
masked by a node's slot and its run's length, give the node's siblings, and the
first child of a run hashes the parent. Windows are cut by run, so a group
with a third of all rows is spread like any other.

Digests are lower-case hex SHA-256, and parents hash their children's hex text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

PATH = "array<struct<left: string, right: string>>"
RANGE_ROWS = 1 << 20


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(*told)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their number from 0 within ``tree`` by ``order``, and ``n``, the tree's size.

    ``rows`` is a written table. It is dealt out by range, a task per million
    rows at least, and numbered as it lies; equal rows may part anywhere.
    """
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)
    by = ["tree", *order, "__tie"]
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *by)
    # The number holds the task in its upper bits, and counts the task's rows from 0 in the 33 below.
    numbered = dealt.sortWithinPartitions(*by).drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    numbered = stored(numbered)
    part = F.shiftright("__at", 33).alias("__part")
    spans = numbered.groupBy("tree", part).agg(F.min("__at").alias("first"), F.count("*").alias("held"))
    every = Window.partitionBy("tree")
    before = F.sum("held").over(every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    moved = spans.select(
        "tree",
        "__part",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__shift"),
        F.sum("held").over(every).alias("n"),
    )
    placed = numbered.withColumn("__part", part).join(stored(moved), ["tree", "__part"])
    return placed.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")


def with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` (tree, pos, n, hash) with the hashes ``left`` and ``right`` of each in its run.

    Adds ``above``, the parent's position, and ``slot``.
    """
    slot, run = F.expr(f"pos % {fan}"), F.expr(f"pos DIV {fan}")
    placed = nodes.withColumns({"slot": slot, "above": run})
    length = F.least(F.lit(fan), F.expr(f"n - above * {fan}"))
    near = Window.partitionBy("tree", "above").orderBy("pos")
    left = [F.when(F.col("slot") >= k, F.lag("hash", k).over(near)) for k in range(fan - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(near)) for k in range(1, fan)]
    return placed.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})


def levels(leaves: DataFrame, fan: int) -> list[DataFrame]:
    """``tree, pos, n, hash`` of each level, the leaves first.

    A tree is in all levels up to the one where it has a single node, its root.
    """
    found = [leaves.select("tree", "pos", "n", "hash")]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        nodes = with_siblings(found[-1].filter("n > 1"), fan)
        parents = nodes.filter("slot = 0").select(
            "tree",
            F.col("above").alias("pos"),
            F.expr(f"CAST(ceil(n / {fan}) AS LONG)").alias("n"),
            digest(F.col("hash"), F.col("right")).alias("hash"),
        )
        found.append(stored(parents))
        most = -(-most // fan)
    return found


def roots(found: list[DataFrame]) -> DataFrame:
    """``tree, hash``: the root of each tree of ``levels``."""
    return reduce(DataFrame.unionByName, [level.filter("n = 1").select("tree", "hash") for level in found])


def paths(found: list[DataFrame], beyond: DataFrame, fan: int, keep: Sequence[str] = ()) -> DataFrame:
    """The leaves with ``path``: their siblings left and right, level by level up to what is ``beyond`` the root.

    ``beyond``: tree, path, and columns ``keep`` that the leaves get as well.
    The leaves, first in ``found``, may hold further columns.
    """
    above = None
    for level in reversed(found):
        own = [c for c in level.columns if c not in {"n", "hash"}]
        # The root of a tree; and all nodes below one, each run next to its parent.
        top = level.filter("n = 1").join(beyond, "tree").select(*own, "hash", *keep, "path")
        if above is not None:
            nodes = with_siblings(level.filter("n > 1"), fan).drop("slot")
            parents = above.select("tree", F.col("pos").alias("above"), "path", *keep)
            step = F.array(F.struct("left", "right")).cast(PATH)
            lower = nodes.join(parents, ["tree", "above"]).withColumn("path", F.concat(step, "path"))
            top = top.unionByName(lower.select(*top.columns))
        above = stored(top) if level is not found[0] else top
    return above


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(
    rows: DataFrame,
    *,
    id_column: str = "doc_id",
    group_column: str = "source",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    carry: Mapping[str, Column] | None = None,
    fan: int = 16,
) -> DataFrame:
    """Digest, proof and roots of every row.

    Rows ascend by id within their group, groups by their UTF-8 bytes with null
    first. Returns ``id_column``, ``leaf``, ``subroot`` (the group's), ``root``,
    ``path`` (for each level the siblings' digests left and right of the way up,
    joined) and the columns ``carry``, computed from the row. A null id comes
    first; equal ids follow each other by digest; equal rows are separate
    leaves. A null group is a group. An empty table gives an empty result.
    Other columns are not looked at.
    """
    carry = carry or {}
    # '-' is before '=': the null group is before all others.
    group = F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit("-"))
    digests = stored(
        rows.select(
            group.alias("tree"),
            F.col(id_column).alias("key"),
            row_digest([F.col(f) for f in fields]).alias("hash"),
            *[value.alias(f"carry_{name}") for name, value in carry.items()],
        )
    )
    leaves = stored(ranked(digests, ["key", "hash"]))
    found = levels(leaves, fan)
    subroots = stored(roots(found))
    groups = stored(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"), ["group"]))
    upper = levels(groups, fan)
    none = F.array().cast(PATH).alias("path")
    last = stored(roots(upper).select("tree", F.col("hash").alias("root"), none))
    over = paths([groups, *upper[1:]], last, fan, ["root"])
    over = stored(over.select(F.col("group").alias("tree"), F.col("hash").alias("subroot"), "root", "path"))
    every = paths([leaves, *found[1:]], over, fan, ["subroot", "root"])
    return every.select(
        F.col("key").alias(id_column),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "path",
        *[F.col(f"carry_{name}").alias(name) for name in carry],
    )
