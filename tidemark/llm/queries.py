"""The registered queries: each operator on its whole table, as the contract names its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations,
    decontaminate,
    language,
    licenses,
    merkle,
    mixing,
    neardup,
    pages,
    pii,
    repeats,
    secrets,
    simhash,
    sketches,
)
from .shared import ascii_lower


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mix_sources(spark, sf):
    return mixing.mix(_table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def _spans(findings: str, wanted: str = "true") -> Column:
    """``kind:start:end`` of an array of findings, comma-joined in its order."""
    return F.expr(
        f"array_join(transform(filter({findings}, f -> {wanted}),"
        " f -> concat_ws(':', f.kind, f.start, f.end)), ',')"
    )


def _count(findings: str, kind: str) -> Column:
    return F.expr(f"CAST(size(filter({findings}, f -> f.base AND f.kind = '{kind}')) AS LONG)").alias(f"n_{kind}")


def op2_secrets(spark, sf):
    found = secrets.find_secrets(_table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        *[_count("findings", kind) for kind in secrets.KINDS],
        F.sha2(_spans("findings", "f.base"), 256).alias("base_sha256"),
        _spans("findings").alias("spans"),
        F.expr("CAST(size(filter(findings, f -> f.live)) AS LONG)").alias("n_live"),
    )


def op3_personal_data(spark, sf):
    found = pii.find_personal_data(_table(spark, sf, "documents"))
    counts = [
        F.expr(f"CAST(size(filter(findings, f -> f.kind = '{kind}')) AS LONG)").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_spans("findings", f"f.kind <> '{pii.TERM}'"), 256).alias("base_sha256"),
        _spans("findings").alias("spans"),
    )


def op4_decontaminate(spark, sf):
    found = decontaminate.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_remove_repeats(spark, sf):
    return repeats.remove_repeats(_table(spark, sf, "documents")).drop("kept")


def op6_licenses(spark, sf):
    found = licenses.scan_licenses(_table(spark, sf, "documents"))
    base = F.array_join(F.array_sort(F.array_distinct(F.col("places.label"))), ",")
    containment = F.coalesce(F.array_max(F.col("blocks.containment")), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.start")).cast("long").alias("first_word"),
        F.array_max(F.col("places.start")).cast("long").alias("last_word"),
        base.alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(containment).alias("score"),
    )


def op7_minhash_near_duplicates(spark, sf):
    found = neardup.near_duplicates(_table(spark, sf, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_bottom_k_sketches(spark, sf):
    return sketches.compare_with_edits(_table(spark, sf, "documents"))


def op9_identify_languages(spark, sf):
    docs = _table(spark, sf, "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    held = language.held_out(F.col("doc_id")).alias("held_out")
    named = language.identify(docs.select("doc_id", "text"), model)
    return named.select(
        "doc_id", held, F.col("predicted.language").alias("lang_pred"), F.col("predicted.score").alias("score")
    )


def op10_extract_pages(spark, sf):
    return pages.extract(_table(spark, sf, "pages"))


def op11_simhash_near_duplicates(spark, sf):
    found = simhash.near_duplicates(_table(spark, sf, "documents"), shingle=3, radius=2)
    printed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", printed, "component_id")


def op12_merkle_manifest(spark, sf):
    """Every fifth document or so claims a text in lower case."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    claimed = [ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in fields]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    carry = {"claim": F.when(touched, merkle.row_digest(claimed))}
    found = merkle.manifest(_table(spark, sf, "documents"), fields=fields, carry=carry, fan=16)
    folded = found.withColumn("folded_root", merkle.folded(F.coalesce("claim", "leaf")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_phrase_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"), least=30, longest=4, first=2000, covered=80)


QUERIES = {f.__name__: f for f in (
    op1_mix_sources,
    op2_secrets,
    op3_personal_data,
    op4_decontaminate,
    op5_remove_repeats,
    op6_licenses,
    op7_minhash_near_duplicates,
    op8_bottom_k_sketches,
    op9_identify_languages,
    op10_extract_pages,
    op11_simhash_near_duplicates,
    op12_merkle_manifest,
    op13_phrase_collocations,
)}
# The same results in DuckDB's SQL, by comparing everything with everything.

_LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = r"regexp_extract_all(" + _LOWERED + r", '[^\x20\x09-\x0D]+')"



def _merkle_sql(deepest: int = 8) -> str:
    """Nodes level by level, by grouping; a node that is alone in its tree goes up as it is."""

    def fields(text: str) -> str:
        each = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return " || ".join(f"coalesce(CAST(octet_length(encode({e})) AS VARCHAR) || ':' || {e}, '-')" for e in each)

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 of the decimal digits, bit by bit.
    bits = "list_reduce([c] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    digits = "list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)"
    rounds = bits.replace("[c]", "[xor(c, b)]")
    crc = f"xor(list_reduce([4294967295::BIGINT] || {digits}, lambda c, b: {rounds}), 4294967295)"

    parts = [f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source, sha256({fields("text")}) AS leaf,
             CASE WHEN {crc} % 5 = 0 THEN sha256({fields(low)}) END AS claim FROM documents),
a0 AS (SELECT r, source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
       count(*) OVER (PARTITION BY source) AS n, leaf AS hash FROM doc)"""]

    def tree(name: str) -> str:
        """CTEs ``name``1 and on: levels; ``name``_up: what is on a first-level node's way."""
        for k in range(deepest):
            parts.append(f"""{name}{k + 1} AS (
SELECT tree, pos // 16 AS pos, any_value(n) AS was, CASE WHEN any_value(n) = 1 THEN any_value(hash)
       ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash, count(*) OVER (PARTITION BY tree) AS n
FROM {name}{k} GROUP BY tree, pos // 16)""")

    tree("a")
    parts.append(f"""b0 AS (SELECT tree AS source, 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos,
       count(*) OVER () AS n, hash FROM a{deepest})""")
    tree("b")
    for name in "ab":
        for k in range(deepest):
            parts.append(f"""{name}s{k} AS (
SELECT x.tree, x.pos, coalesce(string_agg(y.hash, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos), '') AS lft,
       coalesce(string_agg(y.hash, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos), '') AS rgt, any_value(x.n) > 1 AS step
FROM {name}{k} x JOIN {name}{k} y ON x.tree IS NOT DISTINCT FROM y.tree AND x.pos // 16 = y.pos // 16
GROUP BY x.tree, x.pos)""")

    def climb(state: str, name: str) -> str:
        """Folds ``fold`` and ``proof`` of table ``state`` over the levels of ``name``."""
        for k in range(deepest):
            parts.append(f"""{name}c{k} AS (
SELECT c.* REPLACE (c.pos // 16 AS pos, CASE WHEN step THEN sha256(lft || fold || rgt) ELSE fold END AS fold,
       CASE WHEN step THEN proof || lft || rgt ELSE proof END AS proof)
FROM {state} c JOIN {name}s{k} s ON c.tree IS NOT DISTINCT FROM s.tree AND c.pos = s.pos)""")
            state = f"{name}c{k}"
        return state

    parts.append("start AS (SELECT r, tree, pos, '' AS proof, coalesce(claim, leaf) AS fold FROM a0 JOIN doc USING (r))")
    over = climb("start", "a")
    parts.append(f"""mid AS (SELECT r, c.tree AS source, 0 AS tree, b0.pos, proof, fold, b0.hash AS subroot
FROM {over} c JOIN b0 ON c.tree IS NOT DISTINCT FROM b0.source)""")
    end = climb("mid", "b")
    return ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, top.hash AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = top.hash AS verified
FROM {end} JOIN doc USING (r), b{deepest} top"""


ORACLE: dict[str, str] = {
    "op4_decontaminate": f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS.format("text")} AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
item_at AS (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM item_at),
doc_at AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win)
           WHERE len(w) >= n),
hit AS (SELECT d.r, d.i, d.n, win.item FROM doc_at d JOIN win
        ON win.n = d.n AND win.phrase = array_to_string(d.w[d.i:d.i + d.n - 1], ' ')),
covered AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM hit),
hits AS (SELECT r, count(*) AS n_hit FROM covered GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS listed
          FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op7_minhash_near_duplicates": f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_TOKENS.format("text")} AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingle a JOIN shingle b
            ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_of JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION
          SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, lowest AS component_id, doc_id = lowest AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS lowest FROM reach GROUP BY a) USING (doc_id)""",
    "op12_merkle_manifest": _merkle_sql(),
    "op13_phrase_collocations": f"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED.format("text")}, '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
phrase AS (SELECT lang, w[i:i + m - 1] AS words FROM placed, range(1, 5) AS sizes(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, words, len(words) AS m, CAST(count(*) AS HUGEINT) AS a FROM phrase GROUP BY lang, words),
total AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
candidate AS (SELECT * FROM f WHERE m >= 2 AND a >= 30),
cut AS (SELECT c.*, k, x.a AS l, y.a AS r, 2000000 * c.a // (x.a + y.a) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate) c
        JOIN f x ON x.lang = c.lang AND x.words = c.words[:k] JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1:]),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_part AS (SELECT lang, words[i:i + s - 1] AS words, a
               FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidate))),
around AS (SELECT lang, words, max(a) AS most FROM inner_part GROUP BY lang, words),
kept AS (SELECT lang, array_to_string(words, ' ') AS phrase, c.a, l, r, score
         FROM lowest c LEFT JOIN around USING (lang, words) WHERE most IS NULL OR 100 * most < 80 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
