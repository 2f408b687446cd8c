import hashlib

import pytest

from tidemark.llm import sketches

from .data import frame, odd_texts, prose


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        changed = sketches.edit_tail(text, other)
        own, now, then = map(sketches.sketch, (text, changed, other))
        out[doc] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), sketches.pack(own), sketches.pack(now),
            sketches.resemblance(own, now), sketches.resemblance(own, then),
        )
    return out


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_every_document_meets_the_next(spark, buckets):
    texts = [(i * 3 - 50, t) for i, t in enumerate(prose(80, size=(0, 300)))] + [(500, None), (501, ""), (None, "last one of all")]
    docs = frame(spark, texts).repartition(5)
    rows = sketches.compare_with_edits(docs, buckets=buckets).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected(texts)
    assert len(rows) == len(texts)


def test_odd_documents(spark):
    docs = frame(spark, odd_texts())
    rows = sketches.compare_with_edits(docs).collect()
    assert len(rows) == docs.count()
    assert sorted(r["n_chars"] for r in rows) == sorted(len(r["text"] or "") for r in docs.collect())
    assert sketches.compare_with_edits(docs.limit(0)).collect() == []
    (one,) = sketches.compare_with_edits(frame(spark, ["a b c d e f g h"])).collect()
    assert one["near_next"] == 1.0
    nameless = sketches.compare_with_edits(frame(spark, [(None, "a b"), (None, "c d")])).collect()
    assert len(nameless) == 2 and all(r["near_next"] == 0.0 for r in nameless)


def test_parts_merge_into_the_whole():
    left, right = prose(1, seed=1, size=(900, 900))[0], prose(1, seed=2, size=(900, 900))[0]
    a, b = sketches.sketch(left), sketches.sketch(right)
    # No shingle spans the seam when the parts share four words there.
    whole = sketches.sketch(left + " " + right)
    merged = sketches.merge(a, b)
    assert len(set(whole) ^ set(merged)) <= 8
    assert sketches.unpack(sketches.pack(a)).tolist() == a.tolist()


def test_estimates():
    words = [f"w{i}" for i in range(6000)]
    a, b = sketches.sketch(" ".join(words[:4000])), sketches.sketch(" ".join(words[2000:]))
    assert sketches.resemblance(a, b) == pytest.approx(1 / 3, abs=0.13)
    assert sketches.distinct(a) == pytest.approx(3996, rel=0.3)
    assert sketches.containment(a, b) == pytest.approx(0.5, abs=0.2)
    empty = sketches.sketch(None)
    assert sketches.resemblance(empty, empty) == 1.0 and sketches.resemblance(a, empty) == 0.0
    assert sketches.containment(empty, a) == 1.0 and sketches.distinct(empty) == 0.0


def test_merge_by_groups(spark):
    texts = prose(30, size=(40, 90))
    docs = frame(spark, texts, sources=("a", "b", None))
    printed = sketches.fingerprint_texts(docs)
    rows = {r["source"]: r["fingerprint"] for r in sketches.merge_by(printed, ["source"], salts=3).collect()}
    for i, source in enumerate(("a", "b", None)):
        whole = sketches.sketch(None)
        for text in texts[i::3]:
            whole = sketches.merge(whole, sketches.sketch(text))
        assert rows[source] == sketches.pack(whole)
