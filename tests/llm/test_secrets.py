import random
import re
import string

from tidemark.llm import queries, secrets

from .data import frame, odd_texts

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(found)]


TEXTS = [
    'PassWord = "hunter2hunter2" and api_key: zzz token=short1 é',
    "AKIA" + "Z" * 16 + " AKIA" + "Z" * 15 + " paſſword=abcdefgh",
    "0" * 24 + "g" + "a" * 23 + " secret: " + "deadbeef" * 4,
    "passwordpassword==abcdef token : 'abc' token=abcdef",
    "free sk_live_9aZ8bY7cX6dW5eV4fU3gT2 here",
]


def test_base_spans(spark):
    docs = frame(spark, TEXTS + odd_texts())
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == docs.count()
    expected = sorted((str(r["doc_id"]), base(r["text"])) for r in docs.collect())
    got = sorted((str(r["doc_id"]), [(f["kind"], f["start"], f["end"]) for f in r["findings"] if f["base"]]) for r in rows)
    assert got == expected
    assert secrets.find_secrets(docs.limit(0)).collect() == []


def test_ownership_tells_examples_from_live_ones(spark):
    key = "AKIA" + "EXAMPLE9" * 2
    shared = [f"text {i} {key}" for i in range(6)]
    own = [f"text {i} AKIA{'LIVE' * 3}{i:04d} sk-{i}qW7eR4tY8uI1oP5aS2dF6" for i in range(6)]
    docs = frame(spark, shared + own, sources=("a", "b", "c", "d", "e", "f"))
    rows = {r["doc_id"]: r["findings"] for r in secrets.find_secrets(docs).collect()}
    for i in range(6):
        (example,) = rows[i]
        assert not example["live"] and example["owners"] == 6 and example["repositories"] == 6
        assert [(f["kind"], f["live"], f["owners"]) for f in rows[6 + i]] == [("access", True, 1), ("generic", True, 1)]
    # A generic token that many owners hold is no finding.
    many = frame(spark, ["see qW7eR4tY8uI1oP5aS2dF6gH now"] * 6, sources=("a", "b", "c", "d", "e", "f"))
    assert all(r["findings"] == [] for r in secrets.find_secrets(many).collect())


def test_a_lone_owners_key_stays_live_in_all_it_has(spark):
    docs = frame(spark, [f"{i} AKIA{'Q' * 16}" for i in range(12)], sources=("a",))
    rows = [f for r in secrets.find_secrets(docs).collect() for f in r["findings"]]
    assert [(f["live"], f["owners"], f["repositories"]) for f in rows] == [(True, 1, 12)] * 12
    assert {r["text"] for r in secrets.mask(docs).collect()} == {f"{i} [secret]" for i in range(12)}


def test_overlaps_are_found_in_one_pass():
    # An assignment may reach over an access key and further ones that begin in it.
    token = "qW7eR4tY8uI1oP5aS2dF6gH"
    text = f"{token} key token={token} x AKIA{'Q' * 20} {token} " * 3
    base = secrets.base_matches(text)
    found = secrets.generic_matches(text, base)
    every = [(m.start(), m.end(), m[0]) for m in secrets.GENERIC.finditer(text)]
    apart = [f for f in every if all(f[1] <= s or e <= f[0] for s, _, e, _ in base)]
    assert found == apart and 0 < len(found) < len(every)
    long = f"token={token} " * 20_000 + f"{token} " * 20_000
    assert len(secrets.generic_matches(long, secrets.base_matches(long))) == 20_000


def test_what_few_owners_repeat_stays_live(spark):
    key, token = "AKIA" + "R" * 16, "qW7eR4tY8uI1oP5aS2dF6gH"
    texts = [f"{i} {key} {token}" if i < 80 else f"{i} clean" for i in range(90)]
    for sources in (("a",), ("a", None)):
        rows = {r["doc_id"]: r["findings"] for r in secrets.find_secrets(frame(spark, texts, sources=sources)).collect()}
        for i in range(90):
            expected = [("access", True), ("generic", True)] if i < 80 else []
            assert [(f["kind"], f["live"]) for f in rows[i]] == expected
    assert "[secret] [secret]" in secrets.mask(frame(spark, texts, sources=("a",))).filter("doc_id = 79").first()["text"]


def test_generic_tokens_of_any_length(spark):
    draw = random.Random(5)
    tokens = ["".join(draw.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in (200, 201, 342, 50_000)]
    # The parts of a signed web token, and keys on one line; equal letters and a digit are no secret.
    texts = [f"jwt eyJ.{t}.x end" for t in tokens] + ["see " + "z" * 300 + "1"]
    docs = frame(spark, texts)
    rows = {r["doc_id"]: [(f["kind"], f["start"], f["end"], f["live"]) for f in r["findings"]] for r in secrets.find_secrets(docs).collect()}
    assert rows == {i: [("generic", 8, 8 + len(t), True)] for i, t in enumerate(tokens)} | {4: []}
    masked = {r["doc_id"]: r["text"] for r in secrets.mask(docs).collect()}
    assert masked == dict.fromkeys(range(4), "jwt eyJ.[secret].x end") | {4: texts[4]}


def test_mask(spark):
    docs = frame(spark, [*TEXTS, None, "clean"], sources=("a",))
    rows = {r["doc_id"]: r["text"] for r in secrets.mask(docs).collect()}
    assert rows[0] == '[secret]" and api_key: zzz [secret] é'
    assert rows[5] is None and rows[6] == "clean"
    assert secrets.mask(docs).columns == docs.columns


def test_query_columns(spark):
    row = queries.op2_secrets(spark, "/root/testdata/sf0.001").first()
    assert set(row.asDict()) >= {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}
