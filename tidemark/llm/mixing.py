"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Every source's documents are laid on a line of tokens in a seeded order and cut
into blocks of equal size. The corpus' worth of blocks is dealt to the sources
by highest quotients ``target / (2k + 1)``, each source's blocks are dealt to
its shards the same way, and a shard takes its quota by a seeded systematic
choice of its blocks, in whole passes as long as the quota covers them.

Everything is DataFrame work. What meets in one task is one shard's documents
(``docs_per_shard``, without their texts) or one row per source or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

SPACE = r"[\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; of null, 0."""
    text = F.coalesce(text, F.lit(""))
    # Every word ends at white space or at the end of the text.
    inner = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++"))
    return inner.cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights 1, 2, 3, 1, ... for the sources by code point, null last.

    One row per source meets in one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    at = F.pmod(rank - 1, F.lit(len(cycle)))
    return sources.select("source", F.get(F.array(*map(F.lit, cycle)), at).cast("double").alias("weight"))


def fill_targets(sources: DataFrame, max_repeats: float) -> DataFrame:
    """Targets by weight, none above ``max_repeats`` times its source's size.

    ``sources``: source, source_size, weight. In the order of ``cap / weight``
    a source is capped exactly when the share that all before it leave over
    exceeds its cap, so one ordered pass settles all rounds of resharing.
    """
    cap = F.col("source_size") * F.lit(float(max_repeats))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    ranked = (
        sources.withColumn("cap", cap)
        .withColumn("level", level)
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    )
    # All sources that are not capped share the level of the first of them, the highest.
    shared = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    share = F.coalesce(shared, F.lit(0.0)) * F.col("weight")
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(share, F.col("cap")))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def sainte_lague(
    claims: DataFrame, group: list[str], seats: str, votes: str, most: str, order: list[str]
) -> DataFrame:
    """``claims`` with ``quota``: each group's ``seats`` dealt by highest quotients.

    Row ``i`` may claim quotients ``votes / (2k + 1)`` for ``k`` below ``most``.
    Only quotients that can be near the last seat are listed: dealing with the
    divisors of ``seats + n`` and ``seats - n`` seats (``n`` rows in the group)
    bounds every quota from above and below, and about three per row lie
    between. Ties go by ``order``, then by ``k``.
    """
    whole = Window.partitionBy(*group)
    total, n = F.sum(votes).over(whole), F.count("*").over(whole)
    share = F.col(votes) / F.nullif(total, F.lit(0.0))

    def dealt(number: Column) -> Column:
        bounded = F.floor(share * F.greatest(number, F.lit(0)) + 0.5)
        return F.least(F.coalesce(bounded, F.lit(0)), F.col(most)).cast("long")

    bounds = claims.select(
        "*", dealt(F.col(seats) - n).alias("__low"), dealt(F.col(seats) + n).alias("__high")
    )
    quotient = F.col(votes) / (2 * F.col("__k") + 1)
    best = whole.orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in order], "__k")
    won = (
        bounds.withColumn("__open", F.col(seats) - F.sum("__low").over(whole))
        .withColumn(
            "__k",
            F.explode_outer(
                F.when(F.col("__high") > F.col("__low"), F.sequence("__low", F.col("__high") - 1))
            ),
        )
        .withColumn("__rank", F.when(F.col("__k").isNotNull(), F.row_number().over(best)))
    )
    extra = F.count(F.when(F.col("__rank") <= F.col("__open"), 1))
    return won.groupBy(*claims.columns).agg((F.first("__low") + extra).alias("quota"))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    max_repeats: int = 3,
    block_tokens: int = 32,
    docs_per_shard: int = 8192,
    seed: int = 0,
) -> DataFrame:
    """Per document, how many of its tokens the mix takes, repeats counted.

    ``weights`` has ``source`` and ``weight`` (positive), a row per source; by
    default 1, 2, 3, repeating, by source name. Returns ``id_column``,
    ``source``, ``size``, ``source_size``, ``target`` and ``taken``, a row per
    input row, in no order.

    The targets of all sources add up to all tokens. A source's ``taken`` adds
    up to its target within a block per shard and pass. No document is taken
    more than ``max_repeats`` times.

    A null or empty text has size 0 and nothing taken. A null source is a
    source of its own, last in the order. Null and repeated ids are kept; rows
    alike in id, source and size are interchangeable. An empty table gives an
    empty result. Other columns are not looked at. A source that ``weights``
    does not list is left out of the mix: its target is 0.
    """
    read = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        token_count(F.col(text_column)).alias("size"),
    )
    # Texts are read once; the rest works on three short columns.
    sized = stored(read)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    if weights is None:
        weights = cyclic_weights(sources)
    else:
        weights = weights.select("source", F.col("weight").cast("double"))
    weighed = sources.alias("s").join(weights.alias("w"), F.expr("s.source <=> w.source"), "left")
    weighed = weighed.selectExpr("s.source", "source_size", "docs", "weight")
    targets = fill_targets(weighed.filter("weight > 0").drop("docs"), max_repeats)
    plan = stored(
        weighed.drop("weight", "source_size")
        .alias("s")
        .join(targets.alias("t"), F.expr("s.source <=> t.source"), "left")
        .selectExpr(
            "s.source",
            "docs",
            "coalesce(source_size, 0L) AS source_size",
            "coalesce(target, 0D) AS target",
            f"CAST(ceil(docs / {docs_per_shard}) AS INT) AS shards",
        )
    )

    # An even spread of ids over a source's shards, whatever their pattern.
    drawn = F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))
    placed = (
        sized.alias("d")
        .join(plan.select(F.col("source").alias("of"), "shards"), F.expr("d.source <=> of"))
        .select("id", "source", "size", F.pmod(F.xxhash64(drawn, F.lit(1)), F.col("shards")).alias("shard"))
    )
    shard = ["source", "shard"]
    sizes = placed.groupBy(*shard).agg(F.sum("size").cast("double").alias("tokens"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("tokens") / block_tokens))

    by_source = sizes.groupBy("source").agg(F.sum("blocks").alias("blocks"))
    claims = (
        plan.alias("p")
        .join(by_source.alias("b"), F.expr("p.source <=> b.source"))
        .selectExpr("p.source", "target", f"blocks * {max_repeats} AS most", "0 AS everything")
        .withColumn(
            "seats",
            F.round(F.sum("target").over(Window.partitionBy("everything")) / block_tokens).cast("long"),
        )
    )
    dealt = sainte_lague(claims, ["everything"], "seats", "target", "most", ["source"])
    quotas = dealt.select(F.col("source").alias("of"), F.col("quota").alias("seats"))
    shards = sizes.join(quotas, F.expr("source <=> of")).drop("of")
    shards = shards.withColumn("most", F.col("blocks") * max_repeats)
    dealt = stored(sainte_lague(shards, ["source"], "seats", "tokens", "most", ["shard"]))

    line = Window.partitionBy(*shard).orderBy(drawn, F.col("id").asc_nulls_last(), "size")
    laid = placed.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    quota = dealt.selectExpr("source AS of", "shard AS at", "quota", "blocks")
    met = laid.join(quota, F.expr("source <=> of AND shard = at"))

    # Of n blocks the quota's rest r is spread evenly: block b is taken when
    # (b + start) * r / n passes a whole number, with a seeded start.
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), F.greatest("blocks", F.lit(1)))
    met = met.select(
        "*",
        start.alias("start"),
        F.expr("quota DIV greatest(blocks, 1L)").alias("passes"),
        F.expr("quota % greatest(blocks, 1L)").alias("rest"),
    )

    def taken_before(at: str) -> str:
        """Tokens of the shard's first ``at`` that the rest of the quota takes."""
        block = f"(({at}) DIV {block_tokens})"
        chosen = f"(({block} + start) * rest DIV greatest(blocks, 1L) - start * rest DIV greatest(blocks, 1L))"
        next_one = (
            f"(({block} + 1 + start) * rest DIV greatest(blocks, 1L)"
            f" - ({block} + start) * rest DIV greatest(blocks, 1L))"
        )
        return f"({chosen} * {block_tokens} + {next_one} * (({at}) % {block_tokens}))"

    taken = f"passes * size + {taken_before('end')} - {taken_before('end - size')}"
    met = met.selectExpr("id", "source", "size", f"CAST({taken} AS LONG) AS taken")
    totals = plan.select(F.col("source").alias("of"), "source_size", "target")
    return met.join(totals, F.expr("source <=> of")).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "taken"
    )
