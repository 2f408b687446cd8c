"""Personal data, and the words that give it away.

Fixed patterns find the protected entities: addresses, numbers and so on. A
word that stands near an entity discloses it as far as the corpus lets one
infer the entity from the word: with N documents, n_e of them naming the
entity, n_t holding the word and n_et holding it near the entity,

    information = log2(N * n_et / (n_e * n_t)),  of at most log2(N / n_e).

A word whose share of what there is to know reaches ``generalise`` is
generalised, one that reaches ``remove`` is removed, both only where they stand
near the entity, and only when at least ``support`` documents bear it out.

Everything is DataFrame work. Positions come from the lengths of the matches
and of the text between them, summed over a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

# The kinds in the order they are listed.
KINDS = ["email", "ip", "card", "phone"]
TERM = "term"

# The patterns below match what these stand for, with starts and repeats
# written so that a run of a million characters neither costs a quadratic
# search nor a deep recursion:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
# A match starts where its run of characters starts, or where the last match
# ended. Before email, dots that cannot be inside a domain are turned into
# another character of the local part; before card, separators that do not
# stand between two digits into one that is in no card. Lengths do not change.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9 -])|\G)[0-9][0-9 -]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LOOSE_DOT = r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\."
_LOOSE_SEPARATOR = r"(?<![0-9])[ -]|[ -](?![0-9])"
# What a text must hold to have a match at all.
_NEEDED = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][0-9 -]{14}",
    "phone": r"\+[0-9]",
}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Words of four letters or more; all other characters are between words.
_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]++"


def _prepared(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.regexp_replace(text, _LOOSE_DOT, "%")
    if kind == "card":
        return F.regexp_replace(text, _LOOSE_SEPARATOR, "\x01")
    return text


def _pieces(pattern: str, text: Column) -> Column:
    """``gap, hit`` for each match: the characters before it, and itself."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The last gap, behind the last match, has no partner.
    return F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))


def _located(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """``pieces`` (``keys``, ``nth``, ``gap``, ``hit``) with ``start`` and ``end``."""
    line = Window.partitionBy(*keys).orderBy("nth")
    end = F.sum(F.col("gap") + F.length("hit")).over(line)
    return pieces.withColumn("end", end.cast("long")).withColumn(
        "start", F.col("end") - F.length("hit")
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, F.substr(back, i, F.lit(1)).cast("int")).otherwise(
            2 * F.substr(back, i, F.lit(1)).cast("int")
            - F.when(F.substr(back, i, F.lit(1)) > "4", 9).otherwise(0)
        ),
    )
    return total % 10 == 0


def _valid() -> Column:
    hit = F.col("hit")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return (
        F.when(F.col("kind") == "ip", hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(F.col("kind") == "card", F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def find_entities(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, entity`` of the base patterns in ``rows`` (row, text).

    Matches are leftmost and non-overlapping for each kind; one that fails its
    kind's test is dropped without another try. Positions are code points, ends
    exclusive. ``entity`` tells values apart without holding them.
    """
    text = F.col("text")

    def matches(kind: str) -> Column:
        def named(p: Column, i: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), i.alias("nth"), p["gap"].alias("gap"), p["hit"].alias("hit"))

        found = F.transform(_pieces(_PATTERNS[kind], _prepared(kind, text)), named)
        return F.when(text.rlike(_NEEDED[kind]), found)

    parts = [matches(kind) for kind in KINDS]
    empty = F.array().cast("array<struct<kind:string,nth:int,gap:int,hit:string>>")
    pieces = rows.select("row", F.inline(F.concat(*[F.coalesce(p, empty) for p in parts])))
    value = F.lower(F.regexp_replace("hit", r"[\x20().%-]", ""))
    return (
        _located(pieces, ["row", "kind"])
        .filter(_valid())
        .select("row", "kind", "start", "end", F.xxhash64("kind", value).alias("entity"))
    )


def _free_words(rows: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words of ``rows`` that no entity overlaps, and the entities, both numbered.

    ``row, term, start, end, n``: words count from 1. ``row, entity, n``: an
    entity has the number of the word before it.
    """
    pieces = rows.select("row", F.posexplode(_pieces(_LETTERS, F.col("text"))).alias("nth", "p")).select(
        "row", "nth", "p.gap", "p.hit"
    )
    words = _located(pieces, ["row"]).select(
        "row", "start", "end", F.lower("hit").alias("term"), F.lit(None).cast("long").alias("entity")
    )
    both = words.unionByName(entities.select("row", "start", "end", F.lit(None).cast("string").alias("term"), "entity"))
    there = F.col("entity").isNotNull()
    on = Window.partitionBy("row").orderBy("start", "end", "entity")
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("entity"))
    apart = both.select(
        "*",
        F.max(F.when(there, F.col("end"))).over(on.rowsBetween(Window.unboundedPreceding, -1)).alias("reached"),
        # The next one, going back from the end: frames that end there would be walked again for each word.
        F.last(F.when(there, F.col("start")), ignorenulls=True)
        .over(back.rowsBetween(Window.unboundedPreceding, -1))
        .alias("next"),
    ).filter(there | ((F.col("start") >= F.coalesce("reached", F.lit(0))) & (F.col("end") <= F.coalesce("next", "end"))))
    numbered = stored(apart.withColumn("n", F.count("term").over(on)).select("row", "start", "end", "term", "entity", "n"))
    return (
        numbered.filter("term IS NOT NULL").select("row", "term", "start", "end", "n"),
        numbered.filter("entity IS NOT NULL").select("row", "entity", "n"),
    )


def _near_words(words: DataFrame, entities: DataFrame, radius: int) -> DataFrame:
    """``row, term, entity`` for each word and each entity at most ``radius`` words from it."""
    both = words.select("row", "n", "term", F.lit(None).cast("long").alias("entity")).unionByName(
        entities.select("row", "n", F.lit(None).cast("string").alias("term"), "entity")
    )
    # Word k is behind the entities of k - 1 and less, and in front of those of k and more.
    reach = Window.partitionBy("row").orderBy("n").rangeBetween(-radius, radius - 1)
    met = both.withColumn("met", F.collect_set("entity").over(reach)).filter("term IS NOT NULL")
    return met.select("row", "term", F.explode("met").alias("entity")).distinct()


def find_personal_data(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    radius: int = 5,
    support: int = 2,
    generalise: float = 0.9,
    remove: float = 0.99,
) -> DataFrame:
    """Personal data of every whole text, and the words near it that disclose it.

    Returns ``id_column`` and ``findings``, an array of ``kind, start, end,
    action`` for each input row: the base kinds as listed, then ``term``, each
    by start. ``action`` is ``mask`` for base findings, ``generalise`` or
    ``remove`` for words. A word of any length is weighed against every entity
    within ``radius`` words of it; if it discloses one, it goes wherever it
    stands in a document that names that entity. Documents that name no entity have no findings.

    A null text counts as empty. Null and repeated ids are kept, every row
    being a document of its own. An empty table gives an empty result. Other
    columns are not looked at.
    """
    texts = docs.select(F.col(id_column).alias("doc"), F.coalesce(text_column, F.lit("")).alias("text"))
    suspect = F.lit(False)
    for pattern in _NEEDED.values():
        suspect = suspect | F.col("text").rlike(pattern)
    # A row gets its number here, once; only suspect texts are kept along.
    rows = stored(
        texts.select(
            F.monotonically_increasing_id().alias("row"), "doc", F.when(suspect, F.col("text")).alias("text")
        )
    )
    suspects = rows.filter("text IS NOT NULL").select("row", "text")
    entities = stored(find_entities(suspects))
    named = suspects.join(entities.select("row").distinct(), "row", "left_semi")
    words, places = _free_words(named, entities)
    near = _near_words(words, places, radius)

    # Corpus counts: entities and pairs by their documents, words over all documents.
    n_docs = rows.agg(F.count("*").cast("double").alias("n"))
    n_entity = entities.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = stored(
        near.groupBy("term", "entity").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= support)
    )
    # Of all words, only those that may disclose something are counted.
    candidates = stored(pairs.select("term").distinct())
    listed_words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_LETTERS), F.lit(0)))
    n_term = (
        texts.select(F.explode(listed_words).alias("term"))
        .join(candidates, "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
    )
    known = F.log2(F.col("n") * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    share = known / F.nullif(F.log2(F.col("n") / F.col("n_e")), F.lit(0.0))
    disclosing = stored(
        pairs.join(n_entity, "entity")
        .join(n_term, "term")
        .crossJoin(F.broadcast(n_docs))
        .withColumn("share", share)
        .filter(F.col("share") >= generalise)
        .select("term", "entity", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))
    )
    aimed = (
        entities.select("row", "entity")
        .distinct()
        .join(disclosing, "entity")
        # Of two entities, the stricter action holds.
        .groupBy("row", "term")
        .agg(F.max("action").alias("action"))
    )
    terms = words.join(aimed, ["row", "term"]).select("row", F.lit(TERM).alias("kind"), "start", "end", "action")
    found = entities.select("row", "kind", "start", "end", F.lit("mask").alias("action")).unionByName(terms)
    nth = F.array_position(F.array(*map(F.lit, [*KINDS, TERM])), F.col("kind"))
    listed = found.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(nth.alias("nth"), "start", "end", "kind", "action"))).alias("f")
    )
    shaped = F.transform(
        F.coalesce("f", F.array().cast(listed.schema["f"].dataType)),
        lambda f: F.struct(*[f[c].alias(c) for c in ("kind", "start", "end", "action")]),
    )
    return rows.select("row", "doc").join(listed, "row", "left").select(
        F.col("doc").alias(id_column), shaped.alias("findings")
    )


def sanitise(text: str = "text", findings: str = "findings") -> Column:
    """The text with every finding replaced: ``[email]``, ``[word]`` for a
    generalised word, nothing for a removed one.

    Findings that overlap are replaced together, as the first of them. A null
    text stays null.
    """
    ordered = f"array_sort(transform({findings}, f -> struct(f.start, -f.end AS back, f.kind, f.action)))"
    # Each finding that starts behind all before it, with where the kept text before it begins.
    merged = f"""
        aggregate({ordered},
            named_struct('at', 0L, 'out', CAST(array() AS ARRAY<STRING>)),
            (acc, f) -> if(f.start < acc.at,
                named_struct('at', greatest(acc.at, -f.back), 'out', acc.out),
                named_struct('at', -f.back, 'out', concat(acc.out, array(
                    substring({text}, CAST(acc.at AS INT) + 1, CAST(f.start - acc.at AS INT)),
                    CASE f.action WHEN 'mask' THEN concat('[', f.kind, ']')
                                  WHEN 'generalise' THEN '[word]' ELSE '' END)))),
            acc -> concat(array_join(acc.out, ''), substring({text}, CAST(acc.at AS INT) + 1)))"""
    return F.expr(merged)
