import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import repeats

from .data import frame, odd_texts


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    times = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r) + 1)
        for i in range(len(r) - length + 1):
            if times[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i in range(len(r)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def pieces(seed, n=300):
    draw = random.Random(seed)
    known = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(8, 30))) for _ in range(12)]
    texts = ["".join(draw.choice(known) for _ in range(draw.randint(0, 9))) for _ in range(n)]
    return texts + ["a" * 900, "ab" * 400, "x" * 60, "x" * 59, "y" * 61]


@pytest.mark.parametrize("most", [16384, 2])
def test_equals_brute_force(spark, most):
    texts = pieces(5)
    docs = frame(spark, texts)
    result = repeats.remove_repeats(docs, length=60, gram=16, most=most)
    assert got(result) == brute(texts, 60)


def test_odd_documents(spark):
    docs = frame(spark, [t for t in odd_texts()])
    texts = [r["text"] for r in docs.collect()]
    assert got(repeats.remove_repeats(docs)) == brute(texts, 200)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_kept_bytes(spark):
    shared = "".join(chr(97 + i * 7 % 26) + chr(97 + i % 25) for i in range(120))
    docs = frame(spark, ["start " + shared + " end", "other " + shared + " text"])
    kept = sorted(bytes(r["kept"]) for r in repeats.remove_repeats(docs).collect())
    assert kept == [b"otherext", b"start nd"] or kept == [b"othertext", b"startend"]


def test_suffix_sort_orders_groups():
    draw = random.Random(2)
    strings = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(200)]
    sizes = np.array([1, 2, 3, 50, 0, 144])
    sizes = sizes[sizes > 0]
    starts = np.append(0, np.cumsum(sizes)[:-1])
    order, shared = repeats.Suffixes(strings, 12).sort(starts, sizes)
    for s, n in zip(starts, sizes):
        assert [strings[i] for i in order[s : s + n]] == sorted(strings[s : s + n])
        assert shared[s] == -1
        for i in range(s + 1, s + n):
            a, b = strings[order[i - 1]].ljust(12, b"\0"), strings[order[i]].ljust(12, b"\0")
            assert shared[i] == next((k for k in range(12) if a[k] != b[k]), 12)


def test_collisions_are_repaired(monkeypatch):
    monkeypatch.setattr(repeats, "mix", lambda x: x * np.uint64(0))
    order, shared = repeats.Suffixes([b"b", b"a", b"ab"], 4).sort(np.array([0]), np.array([3]))
    assert order.tolist() == [1, 2, 0] and shared.tolist() == [-1, 1, 0]


def test_equal_strings_have_equal_anchors():
    draw = random.Random(4)
    string = bytes(draw.randrange(256) for _ in range(60))
    found = []
    for n in (0, 3, 500):
        raw = np.frombuffer(bytes(draw.randrange(256) for _ in range(n)) + string + b"tail", np.uint8)
        h, _, anchor, first, last = repeats.anchors(raw, 60, 16)
        i = int(np.flatnonzero((first <= n) & (n <= last))[0])
        found.append((int(h[i]), int(anchor[i]) - n))
    assert len(set(found)) == 1
