"""Small documents with everything that may go wrong, and plain reference versions."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, hash string, row int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, sources=("a", "b", None)):
    """Documents with clashing extra columns; a text may come as (id, text)."""
    rows = []
    for i, text in enumerate(texts):
        doc, text = text if isinstance(text, tuple) else (i, text)
        rows.append((doc, text, "en", sources[i % len(sources)], len(text or ""), "x", "y", 1))
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Null, empty, blank, one word, very long, repeated rows, null and repeated ids."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    return [
        None, "", " \t\n", "word", "word", "É ß 😀 ñ", long, "x" * 100_000,
        (None, "no id here at all"), (None, None), (5, "an id again"), (5, "an id again"), (5, None),
    ]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def prose(n, seed=7, vocabulary=60, size=(5, 60)):
    draw = random.Random(seed)
    known = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(draw.choice(known) for _ in range(draw.randint(*size))) for _ in range(n)]


def by_id(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
