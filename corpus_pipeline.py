"""Training corpus in five stages: language, copies, benchmarks, secrets, mixture.

Each stage takes what the one before kept and returns the columns of
``documents``; the last returns what the mixture takes of each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, mixing, neardup, secrets
from tidemark.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _same() -> Column:
    """Documents are told by their id and the hash of their text."""
    return F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_hash"))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return docs.join(rows, _same(), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and those whose language stays unclear.

    The label becomes the predicted language. The classifier learns from the
    documents' own labels; without any, only texts without a letter go.
    """
    model = language.fit(docs)
    named = language.identify(docs.select(*COLUMNS), model, into="__predicted")
    known = named.filter(f"__predicted.language <> '{language.UNKNOWN}' AND __predicted.score >= 0.3")
    if not model.languages:
        known = docs.filter(F.col("text").rlike(r"\p{L}"))
        return known.select(*COLUMNS)
    return known.select("doc_id", "text", F.col("__predicted.language").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id.

    Five-word shingles, similarity 0.8. Of rows that share that id and their
    text, one stays.
    """
    docs = docs.select(*COLUMNS)
    gone, several = neardup.rejected_copies(neardup.near_duplicates(docs, shingle=5, percent=80))
    left = _without(docs, gone)
    once = left.join(several, _same(), "left_semi").dropDuplicates(["doc_id", "text"])
    return _without(left, several).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words inside benchmark windows go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark)
    bad = found.filter("contaminated").select(F.col("doc_id").alias("id"), "text_hash").distinct()
    return _without(docs.select(*COLUMNS), stored(bad))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced in the text; every document stays.

    Widely copied examples are left as they stand.
    """
    masked = secrets.mask(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that each document gives to the mixture, repeats counted."""
    return mixing.mix(docs)


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_contaminated", drop_contaminated),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
]

# A trained classifier decides in the first stage; no SQL expresses it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
