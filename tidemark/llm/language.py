"""Language identification: the family first, then one-versus-one linear SVMs within it.

Features are hashed byte n-grams of the whole text. The machines are fitted on a
bounded sample of labelled texts (``per_language`` of each language, and two
short pieces of each), each machine in a task of its own, which a lost executor
only delays. The driver sees their weights, no feature vector.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

# Families of languages by their codes. A code that is not
# listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
}
UNKNOWN = "und"

BITS = 11
_ASCII_LETTER = re.compile("[A-Za-z]")
# Bytes as the n-grams see them: ASCII letters and all bytes of other
# characters stand for themselves, the rest is a gap.
_SEEN = np.array(
    [b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32
)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of hashed 1-, 2- and 3-gram counts, as a unit vector."""
    seen = _SEEN[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    # Words end in a gap, and gaps have length one.
    seen = np.concatenate(([np.uint32(32)], seen[(seen != 32) | (np.roll(seen, 1) != 32)], [np.uint32(32)]))
    counts = np.zeros(1 << BITS)
    code = np.zeros(len(seen), np.uint32)
    for n in (1, 2, 3):
        code = code[: len(seen) - n + 1] * np.uint32(256) + seen[n - 1 :]
        spread = (code + np.uint32(n)) * np.uint32(2654435761)
        counts += np.bincount(spread >> np.uint32(32 - BITS), minlength=1 << BITS)
    counts = np.sqrt(counts)
    return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


def fit_machine(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, rounds: int = 300) -> np.ndarray:
    """A linear SVM (hinge loss, bias as the last weight); ``y`` is 1 or -1, ``x`` of 32-bit floats.

    Subgradient steps on the whole sample, so the result depends on it alone.
    """
    # Both classes weigh the same.
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    weights, mean = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for step in range(1, rounds + 1):
        # In the precision of x, so that x is never converted.
        wrong = y * (x @ weights[:-1].astype(x.dtype) + weights[-1]) < 1
        pull = share * y * wrong
        pull = np.append(pull.astype(x.dtype) @ x, pull.sum())
        weights = (1 - 1 / step) * weights + pull / (strength * step)
        weights *= min(1, 1 / (np.sqrt(strength) * max(np.linalg.norm(weights), 1e-12)))
        mean += weights * step
    return (mean * 2 / (rounds * (rounds + 1))).astype(np.float32)


# By the two names it tells apart; a positive answer is for the first.
Machines = dict[tuple[str, str], np.ndarray]


@dataclass(frozen=True)
class Model:
    """Machines that tell families apart, and languages within each family."""

    languages: dict[str, list[str]]
    families: Machines
    within: dict[str, Machines]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        family, sure = _vote(sorted(self.languages), self.families, x)
        language, surer = _vote(self.languages[family], self.within[family], x)
        return language, sure * surer


def _vote(names: list[str], machines: Machines, x: np.ndarray) -> tuple[str, float]:
    """Most duels won, then the clearest; how clear its worst duel was."""
    if len(names) == 1:
        return names[0], 1.0
    won, clear = dict.fromkeys(names, 0), dict.fromkeys(names, 1.0)
    for (a, b), weights in machines.items():
        margin = float(x @ weights[:-1] + weights[-1])
        chance = 1 / (1 + np.exp(-2 * min(max(margin, -30), 30)))
        won[a if margin > 0 else b] += 1
        clear[a], clear[b] = min(clear[a], chance), min(clear[b], 1 - chance)
    best = max(names, key=lambda n: (won[n], clear[n]))
    return best, float(clear[best])


def _fit_duels(duels: dict[int, tuple[str, str]], members: dict[str, list[str]], examples: DataFrame) -> Machines:
    """A machine for each duel of two groups of labels, fitted in a task.

    A task holds the vectors of its two groups: ``3 * per_language`` for each label.
    """
    if not duels:
        return {}
    sides = [
        (number, label, sign)
        for number, pair in duels.items()
        for name, sign in zip(pair, (1.0, -1.0))
        for label in members[name]
    ]
    # A row for each label and each duel it is in.
    asked = F.broadcast(examples.sparkSession.createDataFrame(sides, "duel int, label string, side double"))

    def machine(rows: pd.DataFrame) -> pd.DataFrame:
        # The order is the sample's own, wherever its rows come from.
        rows = rows.sort_values(["label", "features"])
        x = np.frombuffer(b"".join(rows["features"]), np.float32).reshape(len(rows), -1)
        weights = fit_machine(x, rows["side"].to_numpy())
        return pd.DataFrame({"duel": [rows["duel"].iat[0]], "weights": [weights.tobytes()]})

    fitted = examples.join(asked, "label").groupBy("duel").applyInPandas(machine, "duel int, weights binary")
    return {duels[r["duel"]]: np.frombuffer(bytes(r["weights"]), np.float32) for r in fitted.collect()}


def family_of(language: str, families: dict[str, list[str]]) -> str:
    return next((f for f, members in families.items() if language in members), language)


def fit(
    labelled: DataFrame,
    *,
    text_column: str = "text",
    label_column: str = "lang",
    key_column: str = "doc_id",
    per_language: int = 400,
    families: dict[str, list[str]] = FAMILIES,
) -> Model:
    """Fit on at most ``per_language`` texts of each language.

    The sample is the rows with the smallest hashes of their key and text, so
    it does not depend on how the rows lie. Rows without text, label, or any
    letter are left out; with no row left the model answers ``und``.
    """
    rows = labelled.select(
        F.col(text_column).alias("text"),
        F.col(label_column).cast("string").alias("label"),
        F.xxhash64(F.col(key_column), F.octet_length(text_column)).alias("drawn"),
    ).filter("text IS NOT NULL AND label IS NOT NULL")
    # One row per language.
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model({}, {}, {})
    spread = 1 << 20
    limits = F.create_map(
        *[F.lit(v) for k, n in counts.items() for v in (k, min(spread, 2 * per_language * spread // n + 64))]
    )
    likely = rows.filter(F.pmod("drawn", F.lit(spread)) < limits[F.col("label")])
    order = Window.partitionBy("label").orderBy(F.pmod("drawn", F.lit(spread)), "drawn", "text")
    sample = likely.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)

    def examples(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for text, label in zip(part["text"], part["label"]):
                middle = text[len(text) // 2 :]
                for piece in (text, middle[:80], middle[80:110]):
                    if has_letter(piece):
                        found.append((label, features(piece).tobytes()))
            yield pd.DataFrame(found, columns=["label", "features"])

    # Bounded by three vectors for each sampled text.
    vectors = stored(sample.select("text", "label").mapInPandas(examples, "label string, features binary"))
    labels = sorted(r["label"] for r in vectors.select("label").distinct().collect())
    languages: dict[str, list[str]] = {}
    for label in labels:
        languages.setdefault(family_of(label, families), []).append(label)
    # Families are told apart from each other, languages within their family.
    groups = {("family", f): members for f, members in languages.items()}
    groups |= {("language", label): [label] for label in labels}
    pairs = [(("family", a), ("family", b)) for a, b in combinations(sorted(languages), 2)]
    pairs += [
        (("language", a), ("language", b)) for members in languages.values() for a, b in combinations(members, 2)
    ]
    machines = _fit_duels(dict(enumerate(pairs)), groups, vectors)
    found = {kind: {(a[1], b[1]): w for (a, b), w in machines.items() if a[0] == kind} for kind in ("family", "language")}
    within = {
        f: {(a, b): w for (a, b), w in found["language"].items() if a in members} for f, members in languages.items()
    }
    return Model(languages, found["family"], within)


def predict(model: Model, text: Column) -> Column:
    """``struct<language string, score double>`` for each text.

    The whole text counts, and nothing else. Null texts and texts without any
    letter give ``und`` with score 0. Equal texts give equal answers. The
    planner computes it once, also where it is filtered by and selected.
    """

    @F.pandas_udf("language string, score double")
    def answer(texts: pd.Series) -> pd.DataFrame:
        found = [
            model.predict(features(t)) if t is not None and has_letter(t) else (UNKNOWN, 0.0)
            for t in texts
        ]
        return pd.DataFrame(found, columns=["language", "score"])

    # Else a filter on the answer would have a copy of its own.
    return answer.asNondeterministic()(text)


def identify(
    docs: DataFrame, model: Model, *, text_column: str = "text", into: str = "predicted"
) -> DataFrame:
    """``docs`` with one more column, the answer for each row as a struct.

    All other columns, nulls and repeated rows stay as they are; an empty table
    stays empty. A column named ``into`` is refused rather than replaced.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into} already")
    return docs.select("*", predict(model, F.col(text_column)).alias(into))


def held_out(key: Column, parts: int = 5) -> Column:
    """Whether a row belongs to the part kept from training; null keys do not."""
    rest = F.crc32(key.cast("string").cast("binary")) % parts
    return F.coalesce(rest == 0, F.lit(False))
