import hashlib
import zlib

import pytest

from tidemark.llm import merkle, queries

from .data import LOW, frame, odd_texts, prose


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """The root of a list of digests, and for each node its siblings level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = range(p // 16 * 16, min(p // 16 * 16 + 16, len(nodes)))
            ways[i].append(([nodes[j] for j in run if j < p], [nodes[j] for j in run if j > p]))
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], ways


def brute(rows):
    if not rows:
        return []
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([g[2] for g in sorted(groups[s], key=lambda g: g[:3])]) for s in order}
    root, upper = climb([trees[s][0] for s in order])
    out = []
    for s, over in zip(order, upper):
        for (_, _, own, row), way in zip(sorted(groups[s], key=lambda g: g[:3]), trees[s][1]):
            way, claim = way + over, own
            doc = row["doc_id"]
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and row["text"] is not None:
                claim = leaf(row.asDict() | {"text": row["text"].translate(LOW)})
            fold = claim
            for left, right in way:
                fold = H(*left, fold, *right)
            proof = H(*[x for left, right in way for x in left + right])
            out.append((doc, own, trees[s][0], root, proof, fold, fold == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


@pytest.mark.parametrize(
    "sources",
    [("a",), ("a", "b", None, ""), ("hot",) * 30 + ("é", "-", "=", "z"), tuple(f"s{i}" for i in range(40))],
)
def test_equals_brute_force(spark, tmp_path, sources):
    texts = [t.title() for t in prose(700, seed=5, size=(1, 9))]
    docs = frame(spark, texts, sources)
    got = found(spark, docs, tmp_path)
    assert got == brute(docs.collect())
    assert {r[-1] for r in got} == {True, False}


def test_sizes_around_a_full_run(spark, tmp_path):
    for n in (1, 2, 15, 16, 17, 256, 257, 272, 273):
        docs = frame(spark, [f"T{i}" for i in range(n)], ("s",))
        assert found(spark, docs, tmp_path / str(n)) == brute(docs.collect())


def test_odd_documents(spark, tmp_path):
    docs = frame(spark, odd_texts() * 3)
    got, rows = found(spark, docs, tmp_path), docs.collect()
    assert got == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, ["a"]).limit(0)).collect() == []


def test_positions_do_not_depend_on_the_layout(spark):
    rows = spark.createDataFrame([(f"t{i % 3}", i * 7919 % 1000) for i in range(1000)], "tree string, k long")
    for spread in (rows.coalesce(1), rows.repartition(13)):
        placed = merkle.ranked(merkle.stored(spread), ["k"]).collect()
        for tree in {r["tree"] for r in placed}:
            own = sorted((r["k"], r["pos"], r["n"]) for r in placed if r["tree"] == tree)
            assert [p for _, p, _ in own] == list(range(len(own)))
            assert {n for _, _, n in own} == {len(own)}
