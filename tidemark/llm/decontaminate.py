"""Benchmark decontamination on a distributed positional inverted index.

Benchmark texts are cut into windows of ``window`` words. The index stores
where the windows' rarest terms stand in the corpus: (term, document,
position). Each window's lists, moved back by the term's place in the window,
are intersected from the rarest on; what all of them agree on is a proximity
match within zero words, and is compared word by word to be an exact phrase.

Everything is DataFrame work; texts are read to count terms, to store
postings, and, of documents with a candidate only, to compare phrases.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, word_array

LISTS = 3
# The term under which the index keeps one posting of every document.
EVERY = ""


@dataclass(frozen=True)
class PhraseIndex:
    """Windows of the benchmark, and where their rarest terms stand in the corpus.

    ``windows``: window, phrase, length. ``items``: window, item.
    ``anchors``: window, length, term, offset, rank, lists.
    ``postings``: term, doc, hash, position, n_words; a document is told by its
    id and the hash of its text. ``docs``: doc, hash, n_words, a row per row.
    """

    windows: DataFrame
    items: DataFrame
    anchors: DataFrame
    postings: DataFrame
    docs: DataFrame


def benchmark_windows(items: DataFrame, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """Distinct windows, and which items have them.

    An item with fewer words than ``window``, but some, is one window. A null
    item id counts as an empty one.
    """
    length = F.least(F.lit(window), F.size("words"))
    cut = (
        items.withColumn("length", length)
        .filter("length > 0")
        .select(
            "item",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("words") - F.col("length") + 1),
                    lambda at: F.array_join(F.slice("words", at, F.col("length")), " "),
                )
            ).alias("phrase"),
        )
        .distinct()
    )
    windows = stored(
        cut.select("phrase")
        .distinct()
        .select(
            F.monotonically_increasing_id().alias("window"),
            "phrase",
            F.size(F.split("phrase", " ")).alias("length"),
        )
    )
    return windows, cut.join(windows, "phrase").select("window", "item")


def build_index(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 13,
    lists: int = LISTS,
) -> PhraseIndex:
    """The index of ``docs`` for the windows of ``benchmark``.

    Null texts and texts without words have no postings. Rows that repeat an
    id with another text are documents of their own.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"),
        word_array(F.col(item_text_column)).alias("words"),
    )
    windows, of_items = benchmark_windows(items, window)
    of_items = stored(of_items)
    texts = docs.select(
        F.col(id_column).alias("doc"),
        F.xxhash64(text_column).alias("hash"),
        word_array(F.col(text_column)).alias("words"),
    )

    places = windows.select("window", "length", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    terms = stored(places.select("term").distinct())
    # Spark broadcasts the terms where its own limit lets it, and sorts both sides beyond.
    counts = stored(
        texts.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").count()
    )
    # A window with a term that the corpus lacks cannot occur.
    ranked = (
        places.join(counts, "term")
        .withColumn("known", F.count("*").over(Window.partitionBy("window")))
        .filter(F.col("known") == F.col("length"))
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy("window").orderBy("count", "offset"))
        )
        .filter(F.col("rank") <= lists)
    )
    anchors = stored(
        ranked.select(
            "window", "length", "term", "offset", "rank",
            F.least(F.col("length"), F.lit(lists)).alias("lists"),
        )
    )
    wanted = stored(
        anchors.select("term").union(docs.sparkSession.createDataFrame([(EVERY,)], "term string")).distinct()
    )
    postings = stored(
        texts.withColumn("n_words", F.size("words"))
        .select("doc", "hash", "n_words", F.posexplode(F.concat(F.array(F.lit(EVERY)), F.col("words"))).alias("position", "term"))
        .join(wanted, "term")
        # Words count from 0.
        .select("term", "doc", "hash", (F.col("position") - 1).alias("position"), "n_words")
    )
    return PhraseIndex(
        windows,
        of_items,
        anchors,
        postings.filter(F.col("term") != EVERY),
        postings.filter(F.col("term") == EVERY).select("doc", "hash", "n_words"),
    )


def proximity_matches(index: PhraseIndex, slop: int = 0) -> DataFrame:
    """``window, doc, hash, start``: where a window's rarest terms all stand.

    Each term may be up to ``slop`` words from its place relative to the
    rarest one; with 0 this is the intersection of the moved lists.
    """
    placed = index.postings.join(index.anchors, "term").select(
        "window", "doc", "hash", "rank", "lists", "length", "n_words",
        (F.col("position") - F.col("offset")).alias("start"),
    )
    if slop:
        near = F.when(F.col("rank") == 1, F.array("start")).otherwise(
            F.sequence(F.col("start") - slop, F.col("start") + slop)
        )
        placed = placed.withColumn("start", F.explode(near))
    fits = (F.col("start") >= -slop) & (F.col("start") + F.col("length") <= F.col("n_words") + slop)
    return (
        placed.filter(fits)
        .groupBy("window", "doc", "hash", "start")
        .agg(F.expr("bit_or(shiftleft(1, rank)) AS met"), F.first("lists").alias("lists"))
        .filter("met = shiftleft(1, lists + 1) - 2")
        .select("window", "doc", "hash", "start")
    )


def exact_phrases(
    index: PhraseIndex, docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc, hash, window, start, length`` of every occurrence of a window."""
    candidates = proximity_matches(index).join(index.windows, "window")
    # What meets in a row is one document's candidates.
    grouped = stored(
        candidates.groupBy("doc", "hash").agg(
            F.collect_list(F.struct("window", "start", "length", "phrase")).alias("candidates")
        )
    )
    texts = docs.select(
        F.col(id_column).alias("of"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text")
    )
    met = texts.join(grouped, F.expr("text_hash = hash AND of <=> doc")).select(
        "doc", "hash", "candidates", word_array(F.col("text")).alias("words")
    )

    def stands(c: Column) -> Column:
        return F.array_join(F.slice("words", c["start"] + 1, c["length"]), " ") == c["phrase"]

    return (
        met.select("doc", "hash", F.explode(F.filter("candidates", stands)).alias("c"))
        .select("doc", "hash", "c.window", "c.start", "c.length")
        .distinct()
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 13,
    percent: int = 5,
) -> DataFrame:
    """Per document, the words inside any benchmark window and the items these come from.

    Returns ``id_column``, ``n_words``, ``n_hit``, ``n_items``, ``items``
    (sorted as strings), ``contaminated`` (some words are hit, and at least
    ``percent`` of all) and ``text_hash`` (``xxhash64`` of the text), a row per
    input row.

    A null or empty text has no words and is clean. Null ids equal each other;
    rows that repeat an id with another text are judged apart. An empty
    benchmark leaves everything clean, an empty table gives an empty result.
    Other columns are not looked at.
    """
    index = build_index(
        docs, benchmark, id_column=id_column, text_column=text_column,
        item_column=item_column, item_text_column=item_text_column, window=window,
    )
    hits = stored(exact_phrases(index, docs, id_column=id_column, text_column=text_column))
    line = Window.partitionBy("doc", "hash").orderBy("start", "end")
    reach = F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = (
        hits.select("doc", "hash", "start", (F.col("start") + F.col("length")).alias("end"))
        .distinct()
        .withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), reach)))
        .groupBy("doc", "hash")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    items = (
        hits.join(index.items, "window")
        .groupBy("doc", "hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = words.join(
        items.withColumnsRenamed({"doc": "d", "hash": "h"}), F.expr("hash = h AND doc <=> d")
    ).select(F.col("doc").alias("d"), F.col("hash").alias("h"), "n_hit", "items")
    joined = index.docs.join(found, F.expr("hash = h AND doc <=> d"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("doc").alias(id_column),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
        F.col("hash").alias("text_hash"),
    )
