"""License scans: phrases that stand in a text, and an exact set-similarity join with templates.

A block is a window of words; line ends do not matter. Windows are twice as long
as a template, by powers of two, and overlap by half, so every run of words as
long as the template lies in one. A block meets a template when it contains at least ``threshold`` of
the template's distinct words. Words are ordered by their frequency in the
corpus, rarest first. A block that meets a template of ``n`` words in ``c`` of
them holds one of its ``n - c + 1`` rarest (prefix filter), has ``c`` words or
more (length filter), and behind the first shared word both sides have words
enough left (positional filter). What passes is counted in full.

Everything is DataFrame work. The templates are a small parameter: their
words, in order, are literals of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import NOT_WORD, stored, word_array

# Phrases and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Sentences by which licenses are declared, and the licenses' names.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]


def phrase_places(words: str, phrase: str) -> str:
    """SQL for the positions (from 0) at which ``phrase`` stands in the array ``words``."""
    parts = phrase.split(" ")
    same = " AND ".join(f"get({words}, i + {k}) = '{w}'" for k, w in enumerate(parts))
    return (
        f"if(size({words}) < {len(parts)}, array(),"
        f" filter(sequence(0, size({words}) - {len(parts)}), i -> {same}))"
    )


def _literal(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words)).cast("array<string>")


def template_words(
    docs_words: DataFrame, templates: Sequence[tuple[str, str]], threshold: float
) -> DataFrame:
    """``template, label, words, needed, span``: each template's words, rarest in the corpus first.

    ``docs_words`` has an array ``words`` per document; all of it is counted.
    ``span`` is the least power of two that the template, repeated words
    included, is not longer than.
    """
    spark = docs_words.sparkSession
    named = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(templates)],
        "template int, label string, text string",
    )
    # Written, so that Spark knows how few they are and need not sort all words.
    terms = stored(
        named.withColumn("listed", word_array(F.col("text"))).select(
            "template",
            "label",
            F.expr("CAST(pow(2, ceil(log2(greatest(size(listed), 1)))) AS INT)").alias("span"),
            F.explode(F.array_distinct("listed")).alias("term"),
        )
    )
    counts = (
        docs_words.select(F.explode("words").alias("term"))
        .join(terms.select("term").distinct(), "term")
        .groupBy("term")
        .count()
    )
    ordered = terms.join(counts, "term", "left").select(
        "template", "label", "span", F.struct(F.coalesce("count", F.lit(0)).alias("count"), "term").alias("w")
    )
    size = F.size("words")
    return (
        ordered.groupBy("template", "label", "span")
        .agg(F.sort_array(F.collect_list("w")).alias("ranked"))
        .select("template", "label", "span", "ranked", F.col("ranked.term").alias("words"))
        .withColumn("needed", F.ceil(size * threshold - 1e-9).cast("int"))
    )


def _windows(words: str, vocabulary: Column, span: int, known: Sequence) -> Column:
    """``block, span, words`` of the windows of ``2 * span`` words that hold a rarest word of the templates ``known``."""
    rarest = _literal(sorted({w for r in known for w in r["words"][: len(r["words"]) - r["needed"] + 1]}))
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(span))

    def window(start: Column) -> Column:
        held = F.array_intersect(vocabulary, F.slice(words, start + 1, F.lit(2 * span)))
        return F.struct(start.alias("block"), F.lit(span).alias("span"), held.alias("words"))

    return F.filter(F.transform(starts, window), lambda b: F.arrays_overlap(b["words"], rarest))


def scan_licenses(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.85,
) -> DataFrame:
    """Phrase places and license labels of every whole text.

    Returns ``id_column``, ``n_words``, ``places`` (array of ``start, label``
    of every phrase, by start), ``blocks`` (array of ``block, span, label,
    containment, best`` for every window that meets a template; ``block`` is its
    first word, counted from 0, and it has twice ``span`` words) and ``labels`` (distinct, sorted; of
    a window that meets several templates, those it contains most of, and of
    these the longest), a row per input row.

    A null text counts as empty and has no words. Null and repeated ids are
    kept as they are. An
    empty table gives an empty result. Other columns are not looked at.
    ``phrases`` and ``templates`` are lists of at most some hundred.
    """
    rows = docs.select(F.col(id_column).alias("doc"), F.coalesce(text_column, F.lit("")).alias("text"))
    tokens = rows.select(word_array(F.col("text")).alias("words"))
    listed = stored(template_words(tokens, templates, threshold))
    # At most some hundred templates of some dozen words.
    known = [r for r in listed.orderBy("template").collect() if r["words"]]
    order = sorted({(w["count"], w["term"]) for r in known for w in r["ranked"]})
    vocabulary = _literal([term for _, term in order])
    prefix = sorted({w for r in known for w in r["words"][: len(r["words"]) - r["needed"] + 1]})

    # Only a text in which a phrase's words follow each other is searched for places.
    may_hold = "(?i)" + "|".join(NOT_WORD.join(p.split(" ")) for p, _ in phrases)
    every_place = " , ".join(
        f"transform({phrase_places('words', p)}, i -> named_struct('start', i, 'label', '{label}'))"
        for p, label in phrases
    )
    places = F.expr(f"array_sort(concat({every_place}))")
    windows = [
        _windows("words", vocabulary, span, [r for r in known if r["span"] == span])
        for span in sorted({r["span"] for r in known})
    ]
    none_held = F.array().cast("array<struct<block:int,span:int,words:array<string>>>")
    blocks = F.concat(none_held, *windows)
    no_places = F.array().cast("array<struct<start:int,label:string>>")
    scanned = stored(
        rows.select("doc", "text", word_array(F.col("text")).alias("words"))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc",
            F.size("words").cast("long").alias("n_words"),
            F.when(F.col("text").rlike(may_hold), places).otherwise(no_places).alias("places"),
            F.when(F.arrays_overlap("words", _literal(prefix)), blocks).alias("blocks"),
        )
    )

    entries = listed.select(
        "template", "label", "span", F.col("words").alias("wanted"), "needed",
        F.explode(F.slice("words", F.lit(1), F.size("words") - F.col("needed") + 1)).alias("shared"),
    )
    probes = scanned.select("row", F.explode("blocks").alias("b")).select(
        "row", "b.block", "b.span", "b.words", F.explode("b.words").alias("shared")
    )
    left = F.least(
        F.size("wanted") - F.array_position("wanted", F.col("shared")),
        F.size("words") - F.array_position("words", F.col("shared")),
    )
    containment = F.size(F.array_intersect("wanted", "words")) / F.size("wanted")
    met = (
        probes.join(entries, ["shared", "span"])
        # A pair is met at its first shared word, in the common order.
        .filter(F.get(F.array_intersect("wanted", "words"), F.lit(0)) == F.col("shared"))
        .filter((F.size("words") >= F.col("needed")) & (left + 1 >= F.col("needed")))
        .withColumn("containment", containment)
        .filter(F.size(F.array_intersect("wanted", "words")) >= F.col("needed"))
        .groupBy("row", "block", "span", "label")
        .agg(F.max(F.struct("containment", F.size("wanted").alias("words"))).alias("fit"))
        .groupBy("row", "block", "span")
        .agg(F.max("fit").alias("most"), F.collect_list(F.struct("label", "fit")).alias("all"))
        .select("row", "block", "span", "most", F.inline("all"))
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("block", "span", "label", "fit.containment", (F.col("fit") == F.col("most")).alias("best"))
                )
            ).alias("met")
        )
    )
    none = F.array().cast("array<struct<block:int,span:int,label:string,containment:double,best:boolean>>")
    joined = scanned.join(met.withColumnRenamed("row", "of"), F.expr("row = of"), "left").withColumn(
        "met", F.coalesce("met", none)
    )
    best = F.filter("met", lambda m: m["best"])
    labels = F.array_sort(F.array_distinct(F.concat(F.col("places.label"), best["label"])))
    return joined.select(
        F.col("doc").alias(id_column), "n_words", "places", F.col("met").alias("blocks"), labels.alias("labels")
    )
