import math
import random
from collections import Counter

import regex as re

from pyspark.sql import functions as F

from tidemark.llm import pii

from .data import frame, odd_texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [
        (k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])
    ]


def found_base(rows):
    return [(f["kind"], f["start"], f["end"]) for f in rows if f["kind"] != pii.TERM]


def test_base_spans_of_random_texts(spark):
    draw = random.Random(1)
    parts = ["1", "2", "25", "999", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "%", "1.2.3.4",
             "4111111111111111", "é", "\n", "😀", "_"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    texts.append("a." * 50_000 + "@" + "b." * 50_000 + "1 " * 50_000)
    docs = frame(spark, texts + odd_texts())
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == docs.count()
    got = sorted((str(r["doc_id"]), found_base(r["findings"])) for r in rows)
    assert got == sorted((str(r["doc_id"]), base(r["text"])) for r in docs.collect())
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_words_that_disclose_an_entity(spark):
    # "zebrafish" stands only near the address, "common" everywhere.
    near = [f"call common zebrafish me@mail.example.org common text number {i}" for i in range(4)]
    far = [f"common text of other things number {i}" for i in range(40)]
    docs = frame(spark, near + far)
    rows = {r["doc_id"]: r["findings"] for r in pii.find_personal_data(docs, radius=3).collect()}
    for i in range(4):
        start = near[i].index("zebrafish")
        assert [(f["kind"], f["start"], f["end"], f["action"]) for f in rows[i] if f["kind"] == pii.TERM and f["start"] == start] == [
            ("term", start, start + 9, "remove")
        ]
        held = {near[i][f["start"] : f["end"]] for f in rows[i] if f["kind"] == pii.TERM}
        assert "common" not in held
    assert all(not rows[i] for i in range(4, 44))
    # One document alone bears nothing out.
    alone = pii.find_personal_data(frame(spark, near[:1] + far), radius=3).collect()
    assert all(f["kind"] != pii.TERM for r in alone for f in r["findings"])


def entity(kind, hit):
    return kind, re.sub(r"[\x20().%-]", "", hit).lower()


def brute_terms(texts, radius, support=2, generalise=0.9, remove=0.99):
    """``term`` spans and their actions, by counting words and entities of all texts."""
    docs, near, n_e, n_t = [], Counter(), Counter(), Counter()
    for text in texts:
        spans = [(s, e, entity(k, text[s:e])) for k, s, e in base(text)]
        every = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\p{L}+", text)]
        free = [w for w in every if all(w[1] <= s or e <= w[0] for s, e, _ in spans)]
        pairs = set()
        for s, _, named in spans:
            before = sum(w[0] < s for w in free)
            for w in free[max(0, before - radius) : before + radius]:
                pairs.add((w[2], named))
        near.update(pairs)
        n_e.update({named for _, _, named in spans})
        n_t.update({w[2] for w in every})
        docs.append((spans, free))
    n, out = len(texts), []
    actions = {}
    for (term, named), both in near.items():
        if both >= support and n > n_e[named]:
            share = math.log2(n * both / (n_e[named] * n_t[term])) / math.log2(n / n_e[named])
            if share >= generalise:
                actions[term, named] = "remove" if share >= remove else "generalise"
    for spans, free in docs:
        found = []
        for s, e, term in free:
            held = {actions[term, named] for _, _, named in spans if (term, named) in actions}
            found += [(s, e, max(held))] if held else []
        out.append(found)
    return out


def term_spans(rows):
    return [(f["start"], f["end"], f["action"]) for f in rows if f["kind"] == pii.TERM]


def test_terms_equal_brute_force(spark):
    draw = random.Random(6)
    common = ["the", "a", "of", "text", "é", "number", "call", "mail"]
    rare = ["zebrafish", "ox", "q", "ñandu", "blue", "green"]
    named = ["me@mail.org", "you@mail.org", "+49 30 1234567", "+33 1 23456789", "1.2.3.4", "4111 1111 1111 1111"]
    texts = []
    for i in range(160):
        words = draw.choices(common, k=draw.randint(3, 20))
        for _ in range(draw.randint(0, 3)):
            who = draw.randrange(6)
            at = draw.randrange(len(words))
            # Each has a word of its own, mostly near it.
            words[at:at] = [named[who], draw.choice(common), rare[who]] if draw.random() < 0.8 else [named[who]]
        texts.append(" ".join(words) + f" {i}")
    for radius in (1, 2, 5):
        rows = {r["doc_id"]: r["findings"] for r in pii.find_personal_data(frame(spark, texts), radius=radius).collect()}
        expected = brute_terms(texts, radius)
        assert [term_spans(rows[i]) for i in range(len(texts))] == expected
        # Each stands two words behind its entity.
        assert (sum(map(len, expected)) > 20) == (radius > 1)


def test_entities_in_reach_all_count(spark):
    # A fresh address stands between the word and the number that repeats.
    near = [f"Zebrafish u{i}x@mail{i}.org +49 30 1234567 and later the zebrafish ox again" for i in range(4)]
    far = [f"text of other things, number {i}, again and later the rest" for i in range(40)]
    rows = {r["doc_id"]: r["findings"] for r in pii.find_personal_data(frame(spark, near + far)).collect()}
    for i in range(4):
        held = [near[i][s:e] for s, e, _ in term_spans(rows[i])]
        # Both places, and a short word as well.
        assert held == ["Zebrafish", "zebrafish", "ox"]
    assert all(not rows[i] for i in range(4, 44))


def test_sanitise(spark):
    docs = frame(spark, ["mail a@b.co or +49 30 1234567, or 1.2.3.4!", "nothing", None])
    found = pii.find_personal_data(docs)
    rows = docs.join(found, "doc_id").select("doc_id", pii.sanitise().alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in rows} == {0: "mail [email] or [phone], or [ip]!", 1: "nothing", 2: None}


def test_main_path_runs_no_python(spark):
    plan = pii.find_personal_data(frame(spark, ["a@b.co"])).select(F.col("findings"))
    assert "Python" not in plan._jdf.queryExecution().toString()
