"""Secret scans weighed by how many owners share a candidate.

Fixed patterns give the base findings. Every candidate's value is hashed, and
the hashes are counted over the corpus by distinct repositories and distinct
owners: what many owners carry is a copied example. What few carry looks live,
in however many repositories they repeat it.
Tokens that only look like secrets (generic candidates) count when they look
live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

# The base patterns, in the order that breaks ties between kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The longest run of hexadecimal digits, if it has 24 at least.
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex"]
SHORTEST_VALUE, SHORTEST_ACCESS = 6, 20

# A generic candidate: a whole long token with letters and digits that is no word.
GENERIC = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}+")
GENERIC_BITS = 3.0


def entropy(value: str) -> float:
    """Bits per character."""
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts)


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """``start, kind, end, value`` of all base findings, by start, then by kind."""
    found = []
    # Every assignment has one of the two signs, and they are rare in prose.
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= SHORTEST_VALUE:
                found.append((m.start(), 0, m.end(), m[2]))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= SHORTEST_ACCESS:
            found.append((m.start(), 1, m.end(), m[0]))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m[0]))
    return sorted(found)


def generic_matches(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """``start, end, value`` of long mixed tokens that no base finding overlaps."""
    found, at, reach = [], 0, 0
    for m in GENERIC.finditer(text):
        value = m[0]
        # Both lists ascend: how far the base findings reach that begin before this one's end.
        while at < len(taken) and taken[at][0] < m.end():
            reach, at = max(reach, taken[at][2]), at + 1
        apart = reach <= m.start()
        if apart and any(map(str.isalpha, value)) and entropy(value) >= GENERIC_BITS:
            found.append((m.start(), m.end(), value))
    return found


_CANDIDATE = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_hash", pa.binary()), ("base", pa.bool_())]
)
CANDIDATE = "struct<kind:string,start:bigint,end:bigint,value_hash:binary,base:boolean>"


def scan(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", owner_column: str = "source"
) -> DataFrame:
    """``doc``, ``text_hash``, ``owner`` and the candidates of each whole text; values only as hashes."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(owner_column).cast("string").alias("owner"),
        F.col(text_column).alias("text"),
    )
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("owner", pa.string()), ("candidates", pa.list_(_CANDIDATE))])

    def digest(value: str) -> bytes:
        return hashlib.sha256(value.encode("utf-8", "replace")).digest()[:16]

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for text in part.column("text"):
                text = text.as_py() or ""
                base = base_matches(text)
                found = [
                    {"kind": KINDS[k], "start": s, "end": e, "value_hash": digest(v), "base": True}
                    for s, k, e, v in base
                ]
                for s, e, v in generic_matches(text, base):
                    found.append({"kind": "generic", "start": s, "end": e, "value_hash": digest(v), "base": False})
                out.append(found)
            columns = [*(part.column(c) for c in ("doc", "text_hash", "owner")), pa.array(out, pa.list_(_CANDIDATE))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(search, f"doc long, text_hash long, owner string, candidates array<{CANDIDATE}>")


def ownership(candidates: DataFrame) -> DataFrame:
    """``value_hash, owners, repositories``: how widely each value is held.

    ``candidates``: value_hash, owner, repository. Equal triples are dropped
    where they are found, and a value is counted per owner first, so that a
    value in a third of all rows costs its tasks one row per owner.
    """
    per_owner = candidates.distinct().groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("value_hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")
    )


def find_secrets(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    example_owners: int = 3,
) -> DataFrame:
    """Secrets of every whole text, told apart into examples and live ones.

    A document's owner is ``owner_column``; each document is a repository of
    its owner. A value that at least ``example_owners`` owners hold is an
    example. Any other one looks live, however often its owners repeat it and
    even if they have nothing without it.

    Returns ``id_column``, ``text_hash`` (``xxhash64`` of the text) and
    ``findings``, an array of ``kind, start, end, base, live, owners,
    repositories`` by start, then by kind as listed, for each input row. Base findings are always there; a generic one only when it
    is live. Positions are code points, ends exclusive.

    A null text counts as empty. A null owner is an owner of its own. Null and
    repeated ids are kept; rows alike in id, owner and findings are one
    repository. An empty table gives an empty result. Other columns are not
    looked at.
    """
    scanned = stored(scan(docs, id_column=id_column, text_column=text_column, owner_column=owner_column))
    # Rows alike in everything are told by their number and put back below.
    marked = (
        scanned.filter(F.size("candidates") > 0)
        .groupBy("doc", "text_hash", "owner", "candidates")
        .agg(F.count("*").alias("copies"))
    )
    marked = stored(marked.select(F.monotonically_increasing_id().alias("row"), "*"))
    single = marked.select("row", "doc", "owner", F.explode("candidates").alias("c"))
    repository = F.coalesce("doc", F.lit(-1)).alias("repository")
    counts = stored(ownership(single.select("c.value_hash", "owner", repository)))
    # Both sides are tables as written: the join can split a value that very many rows hold.
    weighed = (
        single.select("row", "c.*")
        .join(counts, "value_hash")
        .withColumn("live", F.col("owners") < example_owners)
        .filter("base OR live")
    )
    order = F.array_position(F.array(*map(F.lit, [*KINDS, "generic"])), F.col("kind"))
    findings = weighed.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct("start", order.alias("nth"), "end", "kind", "base", "live", "owners", "repositories")
            )
        ).alias("findings")
    )
    shape = ["kind", "start", "end", "base", "live", "owners", "repositories"]
    with_findings = (
        marked.select("row", "doc", "text_hash", "copies")
        .join(findings, "row", "left")
        .select(
            "doc",
            "text_hash",
            F.transform(
                F.coalesce("findings", F.array().cast(findings.schema["findings"].dataType)),
                lambda f: F.struct(*[f[c].alias(c) for c in shape]),
            ).alias("findings"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
    empty = with_findings.schema["findings"].dataType
    without = scanned.filter(F.size("candidates") == 0).select(
        "doc", "text_hash", F.array().cast(empty).alias("findings")
    )
    return with_findings.union(without).withColumnRenamed("doc", id_column)


MASK = "[secret]"


def mask(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", owner_column: str = "source", **limits
) -> DataFrame:
    """``docs`` with every live-looking secret replaced by ``[secret]``.

    Findings that overlap are replaced together. Examples stay, and so do all
    rows and all other columns. Texts without a live finding, null texts among
    them, are untouched.
    """
    found = find_secrets(docs, id_column=id_column, text_column=text_column, owner_column=owner_column, **limits)
    spans = F.transform(F.filter("findings", lambda f: f["live"]), lambda f: F.struct(f["start"], f["end"]))
    live = stored(
        found.select(F.col(id_column).alias("__id"), F.col("text_hash").alias("__hash"), spans.alias("__spans"))
        .filter(F.size("__spans") > 0)
        .dropDuplicates(["__id", "__hash"])
    )

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_replace(t, s) for t, s in zip(texts, spans)])

    same = F.col(id_column).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_column) == F.col("__hash"))
    joined = docs.join(live, same, "left")
    text = F.when(F.isnull("__spans"), F.col(text_column)).otherwise(
        replaced(F.when(F.isnotnull("__spans"), F.col(text_column)), "__spans")
    )
    return joined.withColumn(text_column, text).drop("__id", "__hash", "__spans")


def _replace(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    out, at = [], 0
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]
