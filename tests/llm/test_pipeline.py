"""The stages on planted documents, each against what it must do with them."""

import corpus_pipeline
from tidemark.llm import mixing, neardup, secrets

from .data import frame, prose, tokens
from .test_neardup import brute

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, upto=5):
    found = [docs]
    for _, stage in corpus_pipeline.STAGES[:upto]:
        found.append(stage(spark, found[-1], SF).cache())
    return found


def test_order_and_columns(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["identify_language", "drop_near_duplicates", "drop_contaminated", "mask_secrets", "mix_sources"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for found in run_stages(spark, docs, 4):
        assert found.columns == docs.columns
        assert found.schema.simpleString() == docs.schema.simpleString()


def test_run_equals_its_stages(spark):
    last = run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1]
    once = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, last.collect()), key=str)


def test_planted_documents(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    texts = prose(30, seed=11, vocabulary=900, size=(60, 90))
    key = "AKIA" + "PLANTED7" * 2
    planted = [texts[0], texts[1] + " one more", "12345 ???", item + " " + item, f"{texts[2][:80]} {key} end", None, texts[3]]
    docs = frame(spark, texts + planted + [(3, texts[3])])
    found = run_stages(spark, docs)
    kept = [{r["doc_id"] for r in f.collect()} for f in found]
    assert kept[0] - kept[1] == {32, 35}
    rows = [(r["doc_id"], r["text"]) for r in found[1].collect()]
    assert kept[2] == {d for d, _, _, stays in brute(rows, 5) if stays}
    assert found[2].filter("doc_id = 3").count() == 1
    assert kept[1] - kept[2] >= {30, 31, 36}
    assert kept[2] - kept[3] == {33}
    assert kept[4] == kept[3]
    masked = {r["doc_id"]: r for r in found[4].collect()}
    assert key not in masked[34]["text"] and secrets.MASK in masked[34]["text"]
    assert masked[34]["n_chars"] == len(masked[34]["text"])
    mixed = {r["doc_id"]: r for r in found[5].collect()}
    assert mixed.keys() == kept[4]
    assert all(r["size"] == len(tokens(masked[d]["text"])) and r["taken"] <= 3 * r["size"] for d, r in mixed.items())


def test_documents_are_classified_once(spark):
    docs = frame(spark, prose(20, seed=2) + ["123"])
    plan = corpus_pipeline.identify_language(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_empty_documents(spark):
    docs = frame(spark, ["x"]).limit(0)
    assert [f.count() for f in run_stages(spark, docs)] == [0] * 6


def test_stages_use_the_operators():
    assert corpus_pipeline.mixing is mixing and corpus_pipeline.neardup is neardup
