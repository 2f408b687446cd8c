from tidemark.llm import decontaminate

from .data import frame, odd_texts, prose, words


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if items_of := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= items_of
        out.append((str(doc), len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def check(spark, texts, items):
    docs = frame(spark, texts)
    benchmark = spark.createDataFrame([(i, t, 1, "n") for i, t in items], "item_id long, text string, window int, doc string")
    rows = decontaminate.contamination(docs, benchmark).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], list(r["items"]), r["contaminated"]) for r in rows)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    return got


def test_passages_short_items_and_overlaps(spark):
    items = list(enumerate(prose(12, seed=3, vocabulary=25, size=(5, 40)))) + [(99, "two words"), (None, "one"), (7, None), (8, " . "), (9, "é ß")]
    texts = prose(40, seed=4, vocabulary=25, size=(20, 80))
    for i, (_, text) in enumerate(items[:12]):
        texts[i] = f"{texts[i]} {text.upper()}, {texts[i]} {text}"
    texts += ["Two, WORDS two words one", "É ß é ß", "of some use " * 300 + items[0][1]]
    got = check(spark, texts + odd_texts(), items)
    assert sum(r[5] for r in got) > 5


def test_repetitive_texts(spark):
    check(spark, ["a " * 50, "a b " * 20, "b a " * 6], [(1, "a " * 14), (2, "a b " * 7), (3, "a b a")])


def test_empty_tables(spark):
    docs = frame(spark, ["a b c", None])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in decontaminate.contamination(docs, none).collect()] == [False, False]
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).collect() == []


def test_proximity(spark):
    docs = frame(spark, ["alpha beta gamma", "alpha x beta gamma", "alpha x y z beta gamma"])
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build_index(docs, items)
    assert {r["doc"] for r in decontaminate.proximity_matches(index).collect()} == {0}
    assert {r["doc"] for r in decontaminate.proximity_matches(index, slop=1).collect()} == {0, 1}
    assert {r["doc"] for r in decontaminate.proximity_matches(index, slop=3).collect()} == {0, 1, 2}


def test_main_path_runs_no_python(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.contamination(frame(spark, ["a b c"]), items)
    assert "Python" not in plan._jdf.queryExecution().toString()
