"""Levelled compaction of a store's log.

Days are numbered in their order. Level ``k`` holds merged deltas of ``2 ** k``
days, from number ``i * 2 ** k`` on, so any run of days is covered by few
pieces: at most two of each level. Merged deltas lie beside the log::

    merged/span=FIRST_LAST/__attempt=V/   the delta of days FIRST to LAST
    levels/c=V/                           the spans that attempt V has merged

A span counts once its level's table is there. It never holds the newest day, the
only one that may be redone, so it never goes stale.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import idents
from ..operators.merging import EXACT, merge_deltas
from ..sources.files import exists, folders
from ..sources.schema import ACTION, DAY, as_day, log_schema

Span = tuple[dt.date, dt.date]
SPAN = "span"
SPANS = T.StructType([T.StructField(SPAN, T.StringType()), T.StructField("version", T.StringType())])


def span_name(span: Span) -> str:
    return f"{span[0].isoformat()}_{span[1].isoformat()}"


def merged_spans(spark: SparkSession, root: str) -> dict[Span, str]:
    """The spans that count, and the attempt that holds each: fewer than there are days."""
    folder = f"{root}/levels"
    if not exists(spark, folder):
        return {}
    rows = spark.read.schema(SPANS).option("recursiveFileLookup", True).parquet(folder).collect()
    return {tuple(map(as_day, r[SPAN].split("_"))): r["version"] for r in sorted(rows)}


def cover(days: Sequence[dt.date], first: int, last: int, merged: dict[Span, str]) -> list[Span]:
    """The days numbered ``first`` to ``last`` as merged spans and single days, longest first come."""
    found, at = [], first
    while at <= last:
        size = 1
        while at % (2 * size) == 0 and at + 2 * size - 1 <= last and (days[at], days[at + 2 * size - 1]) in merged:
            size *= 2
        found.append((days[at], days[at + size - 1]))
        at += size
    return found


def read_merged(spark: SparkSession, root: str, schema: T.StructType, spans: dict[Span, str]) -> DataFrame:
    """The merged deltas ``spans``: the log's columns, ``__exact``, ``span``; a span's last day is its ``day``."""
    held = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType()), T.StructField(EXACT, T.BooleanType())])
    columns = [*idents(schema.fieldNames()), ACTION, f"to_date(split({SPAN}, '_')[1]) AS {DAY}", EXACT, SPAN]
    # All of a span may have cancelled out.
    present = set(folders(spark, f"{root}/merged")) if spans else set()
    paths = [
        f"{root}/merged/{SPAN}={span_name(s)}/__attempt={v}"
        for s, v in spans.items()
        if f"{SPAN}={span_name(s)}" in present
    ]
    if not paths:
        empty = held.add(SPAN, T.StringType())
        return spark.createDataFrame([], empty).selectExpr(*columns)
    with_span = T.StructType([*held.fields, T.StructField(SPAN, T.StringType())])
    reader = spark.read.schema(with_span).option("basePath", f"{root}/merged")
    return reader.parquet(*paths).selectExpr(*columns)


def next_spans(days: Sequence[dt.date], size: int) -> dict[Span, tuple[Span, Span]]:
    """The spans of ``size`` days that end before the newest day, and the halves of each."""
    half = size // 2
    return {
        (days[i], days[i + size - 1]): ((days[i], days[i + half - 1]), (days[i + half], days[i + size - 1]))
        for i in range(0, len(days) - size, size)
    }


def compact(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], days, read_log) -> list[Span]:
    """Merge what can be merged and is not yet; returns the new spans.

    One job per level, whatever the number of spans, each over the halves one
    level below. ``read_log`` gives the log of a list of days.
    """
    merged, new, size = merged_spans(spark, root), [], 2
    while size < len(days):
        missing = {s: halves for s, halves in next_spans(days, size).items() if s not in merged}
        if missing:
            halves = {h: s for s, both in missing.items() for h in both}
            if size == 2:
                rows = read_log([h[0] for h in halves]).withColumn(EXACT, F.lit(True))
                rows = rows.withColumn(SPAN, F.concat_ws("_", DAY, DAY))
            else:
                rows = read_merged(spark, root, schema, {h: merged[h] for h in halves})
            into = [(span_name(h), span_name(s)) for h, s in halves.items()]
            # A row per day at most.
            named = F.broadcast(spark.createDataFrame(into, f"{SPAN} string, __into string"))
            version = uuid.uuid4().hex
            rows = rows.join(named, SPAN).withColumn(SPAN, F.col("__into")).drop("__into")
            delta = merge_deltas(rows, keys, SPAN).drop(DAY).withColumn("__attempt", F.lit(version))
            writer = delta.hint("rebalance", F.col(SPAN)).write.mode("append").partitionBy(SPAN, "__attempt")
            writer.parquet(f"{root}/merged")
            listed = spark.createDataFrame([(span_name(s), version) for s in missing], SPANS)
            listed.coalesce(1).write.parquet(f"{root}/levels/c={version}")
            merged |= dict.fromkeys(missing, version)
            new += missing
        size *= 2
    return new


def read_pieces(spark, root, schema, pieces: Sequence[Span], merged: dict[Span, str], read_log) -> DataFrame:
    """The log rows of ``pieces``; of a merged one as if all were of its last day."""
    single = read_log([s[0] for s in pieces if s[0] == s[1]])
    several = {s: merged[s] for s in pieces if s[0] != s[1]}
    if not several:
        return single
    return single.unionByName(read_merged(spark, root, schema, several).select(*idents(log_schema(schema).fieldNames())))
