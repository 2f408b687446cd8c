import random

import numpy as np
import pytest

from tidemark.llm import neardup

from .data import LOW, frame, odd_texts, prose, tokens


def shingles(text, size):
    w = tokens((text or "").translate(LOW))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def brute(rows, size, percent=80):
    """``id, n, component, kept`` by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[root(i)] = min(lowest.get(root(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        component = lowest.get(root(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def edited(text, share, draw):
    return " ".join(w if draw.random() > share else f"n{draw.randrange(10**6)}" for w in text.split())


def chains(seed):
    """Texts that drift apart step by step, copies of them, and noise."""
    draw = random.Random(seed)
    texts = prose(60, seed=seed, vocabulary=400, size=(3, 120))
    for start in texts[:8]:
        at = start
        for _ in range(12):
            at = edited(at, 0.06, draw)
            texts.append(at)
    return texts + texts[5:9] + [t.upper() for t in texts[:3]]


@pytest.mark.parametrize(("size", "most"), [(2, 1024), (5, 1024), (2, 3)])
def test_equals_brute_force(spark, size, most):
    docs = frame(spark, chains(size))
    rows = neardup.near_duplicates(docs, shingle=size, most=most).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], size)
    assert sum(r["kept"] for r in rows) < len(rows)


def test_odd_documents(spark):
    docs = frame(spark, odd_texts())
    rows = neardup.near_duplicates(docs, shingle=2).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 2)
    assert neardup.near_duplicates(docs.limit(0), shingle=2).collect() == []


def test_one_of_each_component_stays(spark):
    texts = ["a b c d e f g", "a b c d e f g", (7, "k l m n"), (7, "k l m n"), (7, None), "", (None, "z y x")]
    docs = frame(spark, texts)
    gone, several = neardup.rejected_copies(neardup.near_duplicates(docs, shingle=2))
    assert [r["id"] for r in gone.collect()] == [1]
    assert [r["id"] for r in several.collect()] == [7]


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1001), (1001, 1000)], "a long, b long")
    found = {r["id"]: r["component"] for r in neardup.components(links).collect()}
    assert found == dict.fromkeys(range(n + 1), 0) | {1000: 1000, 1001: 1000}
    assert neardup.components(links.limit(0)).collect() == []


def test_estimates_are_near_the_truth():
    draw = np.random.default_rng(1)
    errors = []
    for share in (0.5, 0.8, 0.95):
        both, own = int(2000 * share), 2000 - int(2000 * share)
        values = draw.integers(0, 1 << 63, both + own, np.uint64)
        a, b = np.unique(values), np.unique(values[:both])
        x, y = (neardup.planes(neardup.minima(s)) for s in (a, b))
        errors.append(abs(float(neardup.estimate(x, y)) - len(b) / len(a)))
    assert max(errors) < 0.1


def test_links_that_share_only_crowded_buckets(spark):
    # All share a template; only the first two of a family are similar enough, and their
    # common buckets hold hundreds of others, also where two bands are shared.
    texts = []
    for family in range(2):
        template = [f"t{family}x{i}" for i in range(160)]
        texts += [
            " ".join(template + [f"o{family}x{n}x{i}" for i in range(20 if n < 2 else 21)]) for n in range(600)
        ]
    rows = neardup.near_duplicates(frame(spark, texts), shingle=1, most=64).collect()
    expected = {1: 0, 601: 600}
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: expected.get(i, i) for i in range(1200)}


def test_blocks_bring_all_unlike_members_together(spark):
    # A component of 30 and 25 of one or two members, in blocks of 8 at most on average.
    held = {i: 0 if i < 30 else i // 2 for i in range(70)}
    crowded = spark.createDataFrame([(5, i, 70, c) for i, c in held.items()], "bucket long, id long, n long, component long")
    met = {}
    for r in neardup._block_pairs(crowded, 8).collect():
        met.setdefault(r["bucket"], []).append((r["id"], r["side"]))
    pairs = [
        (a, b) for rows in met.values() for a, x in rows for b, y in rows if a < b and (x != y or x == 0)
    ]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) >= {(a, b) for a in held for b in held if a < b and held[a] != held[b]}
    assert max(map(len, met.values())) < 40
