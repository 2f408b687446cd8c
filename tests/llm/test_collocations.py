import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations

from .data import LOW, frame, odd_texts

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
        yield re.findall("[^\x20\x09]+", piece)


def brute(rows, least, longest, first, covered=80):
    out = []
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault(lang or "und", []).extend(pieces(text))
    for lang, listed in by_lang.items():
        f = Counter(
            tuple(w[i : i + m]) for w in listed for m in range(1, longest + 1) for i in range(len(w) - m + 1)
        )
        n = sum(map(len, listed))
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        kept = []
        for p in candidates:
            score, _, l, r = min(
                (2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            longer = [
                q for q in candidates
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * f[q] >= covered * f[p] for q in longer):
                kept.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(docs, **options).collect())


def zipf(seed, n=150, vocabulary=30):
    """Texts whose words differ much in frequency, with set phrases, odd gaps and stops."""
    draw = random.Random(seed)
    known = ["en", "a", "É", "ñu", "b-c"] + ["".join(draw.choice("abcdeé") for _ in range(3)) for _ in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(len(known))]
    texts = []
    for _ in range(n):
        words = draw.choices(known, weights, k=draw.randint(1, 60))
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = draw.choice(["Set phrase one two", "set phrase three", "x x x x x"])
        gaps = [draw.choice([" "] * 8 + ["  ", "\t", ", ", ".\n", "\r", "!?", " : "]) for _ in words]
        texts.append("".join(w + g for w, g in zip(words, gaps)))
    return texts


def documents(spark, texts, langs):
    return frame(spark, texts).drop("lang").join(
        spark.createDataFrame([(i, langs[i % len(langs)]) for i in range(len(texts))], "doc_id long, lang string"),
        "doc_id", "left",
    )


@pytest.mark.parametrize(
    ("least", "longest", "shards", "bits", "first"),
    [(5, 4, 4, 20, 2000), (3, 4, 1, 20, 7), (8, 3, 3, 16, 2000), (4, 4, 4, 15, 2000), (20, 2, 5, 20, 3)],
)
def test_equals_brute_force(spark, least, longest, shards, bits, first):
    docs = documents(spark, zipf(least), ["en", "en", "de", None, "en"])
    expected = brute([(r["lang"], r["text"]) for r in docs.collect()], least, longest, first)
    got = found(docs, least=least, longest=longest, shards=shards, filter_bits=bits, first=first)
    assert got == expected
    assert len(expected) > 5


def test_late_phrases_complete_their_cycle(spark):
    # A pair whose words reach the threshold in the last shard only, then in each shard once more.
    texts = ["alpha beta gamma delta"] * 9
    docs = frame(spark, texts).coalesce(1)
    for shards in (1, 2, 4, 9):
        counts, totals = collocations.phrase_counts(docs, least=9, shards=shards, filter_bits=16)
        assert {r["phrase"]: r["a"] for r in counts.collect()} == dict.fromkeys(
            ["alpha", "beta", "gamma", "delta", "alpha beta", "beta gamma", "gamma delta", "alpha beta gamma",
             "beta gamma delta", "alpha beta gamma delta"], 9,
        )
        assert [tuple(r) for r in totals.collect()] == [("en", 36)]
    with pytest.raises(ValueError):
        collocations.phrase_counts(docs, longest=5)


def test_odd_documents(spark):
    docs = frame(spark, [*odd_texts() * 2, "y." * 50_000, "same words here " * 400])
    expected = brute([(r["lang"], r["text"]) for r in docs.collect()], 30, 4, 2000)
    assert found(docs, shards=2, filter_bits=16) == expected
    assert found(docs.limit(0), shards=2, filter_bits=16) == []


def test_counts_do_not_depend_on_chunks(spark, monkeypatch):
    docs = [("en", t) for t in zipf(1, 40)] + [("de", "one two. " * 300), ("de", ""), (None, "ends here")]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in docs]), pa.array([t for _, t in docs])], names=["lang", "text"])
    every = collocations.Filter(15)
    every.octets[:] = 255
    counts, hashed = [], []
    for size in (1 << 21, 4096, 64, 1):
        monkeypatch.setattr(collocations, "CHUNK", size)
        found, sums = Counter(), Counter()
        for part in collocations._name(4, every)([batch.slice(0, 20), batch.slice(20)]):
            for r in part.to_pylist():
                found[r["lang"], r["size"], r["phrase"]] += r["a"]
        for part in collocations._scan(4, True, every, collocations.Filter(15))([batch]):
            for r in part.to_pylist():
                sums[r["g"]] += r["a"]
        counts.append(Counter({k: a for k, a in found.items() if k[1]}))
        hashed.append(sums)
        assert {k[0]: a for k, a in found.items() if not k[1]} == Counter(
            lang or "und" for lang, text in docs for w in pieces(text) for _ in w
        )
    expected = Counter(
        (lang or "und", m, " ".join(w[i : i + m]))
        for lang, text in docs for w in pieces(text) for m in range(1, 5) for i in range(len(w) - m + 1)
    )
    assert all(c == expected for c in counts)
    assert all(h == hashed[0] for h in hashed)
    assert sorted(hashed[0].values()) == sorted(expected.values())


def test_filter_holds_what_it_was_given(spark):
    draw = np.random.default_rng(0)
    inside, outside = draw.integers(0, 1 << 64, (2, 2000), np.uint64)
    rows = spark.createDataFrame([(int(x),) for x in inside.view(np.int64)], "g long")
    held = collocations.Filter(18)
    for part in (rows.limit(1000), rows):
        held = held.with_blocks(held.bit_blocks(part))
    assert held.holds(inside).all()
    assert held.holds(outside).mean() < 0.01
