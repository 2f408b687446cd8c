import random

import pytest
import xxhash

from tidemark.llm import queries, simhash

from .data import LOW, frame, odd_texts, prose, tokens


def brute_print(text, size=3):
    words = tokens((text or "").translate(LOW))
    runs = [words[i : i + size] for i in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    """``id, fingerprint, component`` by comparing all pairs."""
    prints = [brute_print(text) for _, text in rows]
    component = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and component[i] != component[j]:
                old, new = component[i], component[j]
                component = [new if c == old else c for c in component]
    lowest = {}
    for (doc, _), c in zip(rows, component):
        if doc is not None:
            lowest[c] = min(lowest.get(c, doc), doc)
    return sorted(((doc, f"{p:016x}", lowest.get(c)) for (doc, _), p, c in zip(rows, prints, component)), key=str)


def found(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_simhash_near_duplicates(spark, str(tmp_path)).collect()
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=str)


def test_equals_brute_force(spark, tmp_path):
    draw = random.Random(3)
    texts = prose(60, seed=3, vocabulary=300, size=(1, 400))
    for text in texts[:40]:
        words = text.split()
        for _ in range(3):
            words[draw.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    docs = frame(spark, texts + texts[:3] + odd_texts())
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(spark, docs, tmp_path) == expected
    assert len({c for _, _, c in expected}) < len({p for _, p, _ in expected})


def test_odd_documents(spark, tmp_path):
    docs = frame(spark, odd_texts())
    assert found(spark, docs, tmp_path) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, ["a"]).limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_within_the_radius(spark, radius):
    draw = random.Random(radius)
    values = {0, -1}
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(12):
            values.add(at - (1 << 64) if at >> 63 else at)
            for _ in range(draw.randint(1, radius + 1)):
                at ^= 1 << draw.randrange(64)
    prints = spark.createDataFrame([(v,) for v in values], "print long")
    pairs = [(r["a"], r["b"]) for r in simhash.links(prints, radius).collect()]
    part = {v: v for v in values}
    for a, b in pairs:
        assert 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= radius
        old, new = part[b], part[a]
        part = {v: new if p == old else p for v, p in part.items()}
    for a in values:
        for b in values:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                assert part[a] == part[b]


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "print long"), 3)
