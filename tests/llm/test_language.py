import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, queries

from .data import frame, odd_texts

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op9_identify_languages(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"), per_language=60)


def test_families_come_first(model):
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(model.families) == {("germanic", "romance")}
    assert set(model.within["romance"]) == {("es", "fr")}


def test_odd_documents(spark, model):
    docs = frame(spark, [*odd_texts(), "123 ... !!", "²³", "日本語"])
    rows = language.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["predicted"]["language"] == "und") == (not letters)
        assert letters or r["predicted"]["score"] == 0.0
    assert language.identify(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        language.identify(docs.withColumn("Predicted", F.lit(1)), model)


def test_nothing_to_learn_from(spark):
    docs = frame(spark, ["some text", None])
    empty = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert [r["predicted"]["language"] for r in language.identify(docs, empty).collect()] == ["und", "und"]
    one = language.fit(docs)
    assert language.identify(docs, one).first()["predicted"]["language"] == "en"


def test_prediction_depends_on_the_text_alone(spark, model):
    docs = frame(spark, ["the same text of many words"] * 3, sources=("a", "b", None))
    answers = {tuple(r["predicted"]) for r in language.identify(docs, model).collect()}
    assert len(answers) == 1


def test_machine_separates():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + x[:, 1] > 0, 1.0, -1.0)
    w = language.fit_machine(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.95
