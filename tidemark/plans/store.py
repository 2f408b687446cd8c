"""A table's history on plain Parquet.

Layout, one folder per day and attempt::

    diff/day=D/__attempt=V/      reverse delta: the rows that undo day D
    snapshot/day=D/__attempt=V/  the whole table after day D
    summary/c=N/                 the counts of one or more days, and their attempt V
    digest/day=D/__attempt=V/    digests of the snapshot's key ranges, if wanted
    sketch/day=D/__attempt=V/    sketches of the day's distinct values, if wanted
    merged/, levels/             deltas of several days, see ``levels``

An attempt never touches what an earlier one wrote. It counts from the moment
its summary is there, which is one rename; of several summaries of a day the
one with the highest number holds. Readers keep what they have opened until
``vacuum`` removes what no longer counts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Rule, failing_rule, key_rules, passes
from ..functions.text import idents
from ..operators import changes, history
from ..operators.clean import dedupe
from ..operators.day_sketches import SKETCHES, day_sketches, united_metrics
from ..operators.metrics import snapshot_report
from ..sources.bucketed import read_bucketed, write_bucketed
from ..sources.files import exists, files, folder_bytes, folders, remove
from ..sources.schema import (
    ACTION,
    ADDRESS_KEYS,
    ADDRESS_SCHEMA,
    DAY,
    MALFORMED,
    as_day,
    conform,
    log_schema,
)
from . import digests, levels
from .scratch import scratch_folder

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("inserts", T.LongType()),
        T.StructField("updates", T.LongType()),
        T.StructField("deletes", T.LongType()),
        T.StructField("total", T.LongType()),
        # Rows of the dump that did not enter, by rule; `duplicate` for repeated keys.
        T.StructField("refused", T.MapType(T.StringType(), T.LongType())),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("version", T.StringType()),
        T.StructField("commit", T.LongType()),
        T.StructField(DAY, T.DateType()),
    ]
)

# A bucket is read, sorted and joined by one task.
BUCKET_BYTES = 512 << 20
MAX_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
DUPLICATE = "duplicate"


class Commit(NamedTuple):
    """What a day's newest summary says."""

    number: int
    version: str
    buckets: int


Commits = dict[dt.date, Commit]


class HistoryStore:
    """The history of one table that arrives as a full dump per day.

    Snapshots are bucketed by key, so comparing a day with the day before
    shuffles neither: the only full shuffle of an ingest is the one that
    deduplicates the dump. The number of buckets follows the dump's size, half
    a GB each, and stays put while the size stays within a factor of two;
    ``buckets`` fixes it. Each day remembers its own. With ``digests`` parts to
    a bucket, snapshots get digests by which ``diff`` reads only what differs. With
    the columns ``sketches`` (of the code and the street) each day gets sketches, of which
    ``range_report`` counts over any days. One writer at a time;
    readers may run alongside, and keep their frames through later ingests,
    redone days and failures, until a ``vacuum``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType = ADDRESS_SCHEMA,
        keys: Sequence[str] = tuple(ADDRESS_KEYS),
        rules: Sequence[Rule] | None = None,
        prefer: Sequence[str] = (),
        buckets: int | None = None,
        keep: int = 2,
        digests: int = 0,
        sketches: tuple[str, str] | None = None,
    ) -> None:
        reserved = {DAY, ACTION} & set(schema.fieldNames())
        if reserved:
            raise ValueError(f"column names the log needs for itself: {sorted(reserved)}")
        if keep < 2:
            raise ValueError("keep at least two snapshots: a re-run needs the one before")
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self.keys = list(keys)
        self.rules = list(rules) if rules is not None else key_rules(self.schema, self.keys)
        self.prefer = list(prefer)
        self.buckets = buckets
        self.keep = keep
        self.digests = digests
        self.sketches = sketches

    # Reading

    def _path(self, part: str, day: dt.date, version: str) -> str:
        return f"{self.root}/{part}/{DAY}={day.isoformat()}/__attempt={version}"

    def _summary_rows(self) -> DataFrame:
        """The newest summary of every day."""
        folder = f"{self.root}/summary"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], SUMMARY_SCHEMA)
        reader = self.spark.read.schema(SUMMARY_SCHEMA).option("recursiveFileLookup", True)
        newest = f"row_number() OVER (PARTITION BY {DAY} ORDER BY commit DESC) AS __n"
        return reader.parquet(folder).selectExpr("*", newest).filter("__n = 1").drop("__n")

    def _committed(self) -> Commits:
        """Ingested days and what counts of them: one small row per day."""
        rows = self._summary_rows().select(DAY, "commit", "version", "buckets").collect()
        return dict(sorted((r[DAY], Commit(r["commit"], r["version"], r["buckets"])) for r in rows))

    def days(self) -> list[dt.date]:
        """The ingested days, oldest first."""
        return list(self._committed())

    def summaries(self) -> DataFrame:
        """Inserts, updates, deletes and total of every ingested day."""
        return self._summary_rows().select(DAY, "inserts", "updates", "deletes", "total")

    def refusals(self) -> DataFrame:
        """``day, rule, refused``: rows of each dump that did not enter, and why.

        A row counts under the first rule it breaks; ``duplicate`` counts rows
        that gave way to another one of their key. Rules without rows are absent.
        """
        rows = self._summary_rows().select(DAY, F.explode("refused").alias("rule", "refused"))
        return rows.filter("refused > 0")

    def _read_snapshot(self, day: dt.date, commit: Commit) -> DataFrame:
        path = self._path("snapshot", day, commit.version)
        return read_bucketed(self.spark, path, self.schema, self.keys, commit.buckets)

    def snapshot(self, day: dt.date | str | None = None) -> DataFrame:
        """A stored snapshot, by default the newest."""
        committed = self._committed()
        if not committed:
            raise LookupError(f"nothing ingested yet in {self.root}")
        wanted = max(committed) if day is None else as_day(day)
        if wanted not in self._stored_snapshots(committed):
            raise LookupError(f"no snapshot of {wanted} is stored; use as_of")
        return self._read_snapshot(wanted, committed[wanted])

    def _stored_snapshots(self, committed: Commits) -> list[dt.date]:
        """Days whose snapshot is there, oldest first."""
        names = folders(self.spark, f"{self.root}/snapshot")
        found = [as_day(n.removeprefix("day=")) for n in names if n.startswith("day=")]
        return [
            d
            for d in found
            if d in committed
            and exists(self.spark, self._path("snapshot", d, committed[d].version) + "/_SUCCESS")
        ]

    def log(
        self, after: dt.date | str | None = None, upto: dt.date | str | None = None
    ) -> DataFrame:
        """Reverse deltas of the ingested days in ``(after, upto]``.

        Only those days' folders are listed and read.
        """
        return self._read_log(self._committed(), after, upto)

    def _read_log(self, committed: Commits, after=None, upto=None) -> DataFrame:
        low = as_day(after) if after is not None else dt.date.min
        high = as_day(upto) if upto is not None else dt.date.max
        return self._read_days(committed, [d for d in committed if low < d <= high])

    def _read_days(self, committed: Commits, days: Sequence[dt.date]) -> DataFrame:
        wanted = [(d, committed[d]) for d in days]
        # A day without changes may have no folder.
        present = set(folders(self.spark, f"{self.root}/diff")) if wanted else set()
        paths = [self._path("diff", d, c.version) for d, c in wanted if f"day={d.isoformat()}" in present]
        if not paths:
            return self.spark.createDataFrame([], log_schema(self.schema))
        schema = log_schema(self.schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/diff")
        # Reading by day, Spark adds the attempt's folder as a column.
        return reader.parquet(*paths).select(*idents(schema.fieldNames()))

    def as_of(self, day: dt.date | str) -> DataFrame:
        """The table as it was on ``day``.

        Starts from the oldest stored snapshot that is not before the day, so
        that as little of the log as possible is replayed.
        """
        target = as_day(day)
        committed = self._committed()
        base = self._base(committed, target)
        merged = levels.merged_spans(self.spark, self.root)
        pieces = self._pieces(committed, target, base, merged)
        log = levels.read_pieces(
            self.spark, self.root, self.schema, pieces, merged, lambda days: self._read_days(committed, days)
        )
        return history.as_of(self._read_snapshot(base, committed[base]), log, target, self.keys)

    def pieces(self, day: dt.date | str) -> list[tuple[dt.date, dt.date]]:
        """First and last day of each delta that ``as_of`` replays for ``day``."""
        target = as_day(day)
        committed = self._committed()
        base = self._base(committed, target)
        return self._pieces(committed, target, base, levels.merged_spans(self.spark, self.root))

    def _pieces(self, committed: Commits, target: dt.date, base: dt.date, merged) -> list[levels.Span]:
        days = list(committed)
        first = sum(d <= target for d in days)
        return levels.cover(days, first, days.index(base), merged)

    def versions(self) -> DataFrame:
        """Every row the table ever had, and the day since when; see ``history.versions``."""
        committed = self._committed()
        base = self._base(committed, max(committed, default=dt.date.min))
        return history.versions(self._read_snapshot(base, committed[base]), self._read_log(committed), self.keys)

    def unequal_parts(self, before: dt.date | str, after: dt.date | str) -> DataFrame:
        """``bucket, part, rows_before, rows_after`` of the key ranges in which two stored days differ."""
        found = self._unequal(self._committed(), as_day(before), as_day(after))
        if found is None:
            raise LookupError(f"{before} and {after} have no digests of the same ranges")
        return found[0]

    def _unequal(self, committed: Commits, before: dt.date, after: dt.date) -> tuple[DataFrame, int] | None:
        """What differs, and how many parts a bucket has; none without digests of the same ranges."""
        days = [before, after]
        if not all(d in committed for d in days) or committed[before].buckets != committed[after].buckets:
            return None
        paths = [self._path("digest", d, committed[d].version) for d in days]
        both = set.intersection(*[set(folders(self.spark, path)) for path in paths])
        if not both:
            return None
        name = max(both)
        sides = [self.spark.read.schema(digests.DIGEST).parquet(f"{path}/{name}") for path in paths]
        return digests.unequal(*sides), int(name.removeprefix("parts="))

    def diff(self, before: dt.date | str, after: dt.date | str) -> DataFrame:
        """Every row that differs between two stored snapshots; see ``changes.compare``.

        With digests of both days, only the buckets that differ are read, and in
        them only the parts that differ are joined. Where over half of the
        buckets differ, and without digests, the whole snapshots are joined,
        which takes no shuffle.
        """
        days = [as_day(before), as_day(after)]
        committed = self._committed()
        sides = [self.snapshot(d) for d in days]
        found = self._unequal(committed, *days)
        if found is not None:
            parts, per_bucket = found
            # At most a number per bucket, of which Spark allows maxBuckets.
            wanted = {r[0] for r in parts.select("bucket").distinct().collect()}
            if 2 * len(wanted) <= committed[days[0]].buckets:
                sides = [self._parts_of(d, committed[d], wanted, parts, per_bucket) for d in days]
        return changes.compare(*sides, self.keys, ignore=(), unique_keys=True)

    def _parts_of(
        self, day: dt.date, commit: Commit, buckets: set[int], parts: DataFrame, per_bucket: int
    ) -> DataFrame:
        """The snapshot's rows in ``parts``, from the files of ``buckets`` alone."""
        listed = files(self.spark, self._path("snapshot", day, commit.version))
        paths = [f for f in listed if digests.bucket_of(f.rsplit("/", 1)[-1]) in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        placed = rows.selectExpr("*", *digests.places(self.keys, commit.buckets, per_bucket))
        return placed.join(parts, ["bucket", "part"], "left_semi").drop("bucket", "part")

    def as_of_many(self, days: Sequence[dt.date | str]) -> DataFrame:
        """The table on each of ``days``, with an ``as_of`` column first."""
        targets = sorted({as_day(d) for d in days})
        committed = self._committed()
        base = self._base(committed, targets[-1])
        log = self._read_log(committed, targets[0], base)
        snapshot = self._read_snapshot(base, committed[base])
        return history.as_of_many(snapshot, log, targets, self.keys)

    def _base(self, committed: Commits, target: dt.date) -> dt.date:
        if not committed:
            raise LookupError(f"nothing ingested yet in {self.root}")
        wanted = min(target, max(committed))
        usable = [d for d in self._stored_snapshots(committed) if d >= wanted]
        if not usable:
            raise LookupError(f"no snapshot of {wanted} or later is stored in {self.root}")
        return min(usable)

    def report(self, commune: str = "commune_insee", street: str = "voie_nom") -> DataFrame:
        """Rows, communes, streets and departments of the newest snapshot."""
        return snapshot_report(self.snapshot(), commune, street)

    def range_report(self, first: dt.date | str, last: dt.date | str, by_prefix: bool = False) -> DataFrame:
        """Distinct keys, codes, streets and departments of all days from ``first`` to ``last``.

        Estimates out of the days' sketches; no snapshot and no log is read. See
        ``operators.day_sketches`` for their error. Of ``by_prefix``, a row for each prefix.
        A day without a sketch is refused, unless it had no rows at all.
        """
        committed = self._committed()
        low, high = as_day(first), as_day(last)
        wanted = {d: self._path("sketch", d, c.version) for d, c in committed.items() if low <= d <= high}
        paths = [p for p in wanted.values() if exists(self.spark, p)]
        if len(paths) < len(wanted):
            missing = [d for d, p in wanted.items() if p not in paths]
            # A day without rows has none to sketch; its size follows from the counts of all days.
            sizes = self.summaries().selectExpr(DAY, f"sum(inserts - deletes) OVER (ORDER BY {DAY}) AS size")
            lacking = sizes.filter(F.col(DAY).isin(missing) & (F.col("size") > 0)).orderBy(DAY).first()
            if lacking:
                raise LookupError(f"{lacking[DAY]} has no sketch")
        read = self.spark.read.schema(SKETCHES)
        rows = read.parquet(*paths) if paths else self.spark.createDataFrame([], SKETCHES)
        return united_metrics(rows, ["prefix"] if by_prefix else [])

    # Writing

    def clean(self, dump: DataFrame, extra: str = "refuse") -> DataFrame:
        """A dump as the store would keep it: declared columns, valid keys, one row each.

        Lines that ``read_dump`` has marked as malformed are left out.
        """
        return self._cleaned(conform(dump, self.schema, self.keys, extra), self.keys)

    def _rules_for(self, dump: DataFrame) -> list[Rule]:
        marked = MALFORMED in dump.columns and MALFORMED not in self.schema.fieldNames()
        return [*([Rule("malformed", f"{MALFORMED} IS NULL")] if marked else []), *self.rules]

    def _cleaned(self, dump: DataFrame, keys: Sequence[str]) -> DataFrame:
        rules = self._rules_for(dump)
        valid = dump.filter(passes(rules))
        return dedupe(valid.drop(MALFORMED) if len(rules) > len(self.rules) else valid, keys, self.prefer)

    def ingest(self, day: dt.date | str, dump: DataFrame, extra: str = "refuse") -> DataFrame:
        """Take in a day's dump; returns its change summary.

        The day must be after all ingested days, or be the newest of them,
        which replaces it. A dump that is refused, or a run that fails, leaves
        the store as it was; the dump may come out of the store itself.
        """
        day = as_day(day)
        self._ingest(self._committed(), day, dump, extra)
        return self.summaries().filter(F.col(DAY) == F.lit(day))

    def backfill(
        self, dumps: Mapping[dt.date | str, DataFrame], extra: str = "refuse"
    ) -> DataFrame:
        """Take in separate dumps, oldest first; returns all change summaries."""
        committed = self._committed()
        for day, dump in sorted(dumps.items(), key=lambda item: as_day(item[0])):
            committed = self._ingest(committed, as_day(day), dump, extra)
        return self.summaries()

    def _ingest(self, committed: Commits, day: dt.date, dump: DataFrame, extra: str) -> Commits:
        later = [d for d in committed if d > day]
        if later:
            raise ValueError(f"{day} is before {later[-1]}, which is already ingested")
        dump = conform(dump, self.schema, self.keys, extra)
        rows = self._cleaned(dump, self.keys)
        previous = max((d for d in committed if d < day), default=None)
        before = committed.get(previous)
        if previous is not None and previous not in self._stored_snapshots(committed):
            # Happens when the newest day is redone right after a backfill.
            old = self.as_of(previous).repartition(before.buckets, *idents(self.keys))
            self._write_snapshot(previous, before, old)

        number = max((c.number for c in committed.values()), default=0) + 1
        commit = self._first_write(day, number, dump, rows, before)
        today = self._read_snapshot(day, commit)
        if previous is None:
            delta = today.withColumn(ACTION, F.lit("DELETE"))
        else:
            # Changes are few against the snapshot: regroup them into files of
            # a good size rather than one per bucket.
            by_key = [F.col(k) for k in idents(self.keys)]
            old = self._read_snapshot(previous, before)
            delta = changes.reverse_delta(old, today, self.keys).hint("rebalance", *by_key)
        log = self._path("diff", day, commit.version)
        delta.write.parquet(log)

        # The counts come from what lies on disk, where a task run twice counts once.
        reader = self.spark.read.schema(log_schema(self.schema))
        counts = changes.log_summary(reader.parquet(log), per_day=False)
        kept = self.spark.read.schema(self.schema).parquet(self._path("snapshot", day, commit.version))
        refused = self._refused(dump, kept)
        self._write_summary(number, counts.crossJoin(refused).withColumn(DAY, F.lit(day)), {day: commit})
        return {**committed, day: commit}

    def _first_write(
        self, day: dt.date, number: int, dump: DataFrame, rows: DataFrame, before: Commit | None
    ) -> Commit:
        """Write the day's snapshot, in as many buckets as its size asks for.

        The files of a plain scan tell that size beforehand. Of any other plan the
        estimate may be far off, for a join the product of both sides; where
        it asks for several buckets, the rows are written and measured first.
        """
        size = _estimated_bytes(dump)
        if self.buckets or (size <= BUCKET_BYTES and not _may_grow(dump)) or _plain_scan(dump):
            commit = Commit(number, uuid.uuid4().hex, self._bucket_count(size, before))
            self._write_snapshot(day, commit, rows)
            return commit
        measured = scratch_folder(self.spark)
        try:
            rows.write.parquet(measured)
            size = folder_bytes(self.spark, measured)
            commit = Commit(number, uuid.uuid4().hex, self._bucket_count(size, before))
            spread = self.spark.read.schema(self.schema).parquet(measured)
            spread = spread.repartition(commit.buckets, *[F.col(k) for k in idents(self.keys)])
            self._write_snapshot(day, commit, spread)
            return commit
        finally:
            remove(self.spark, measured)

    def _refused(self, dump: DataFrame, kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """``refused``: how many rows of a dump each rule kept out, per ``by``.

        One pass over the dump's key columns, counted ahead of any shuffle.
        """
        per_rule = (
            dump.selectExpr(*by, f"{failing_rule(self._rules_for(dump))} AS rule")
            .groupBy(*by, "rule")
            .agg(F.count("*").alias("n"))
        )
        kept_rows = kept.groupBy(*by).agg(F.count("*").alias("kept"))
        entries = "map_from_entries(collect_list(struct(rule, n)) FILTER (WHERE rule IS NOT NULL))"
        passed = "coalesce(sum(n) FILTER (WHERE rule IS NULL), 0L)"
        counted = per_rule.groupBy(*by).agg(F.expr(f"{entries} AS rules"), F.expr(f"{passed} AS passed"))
        joined = counted.join(kept_rows, list(by), "left") if by else counted.crossJoin(kept_rows)
        repeated = f"map('{DUPLICATE}', passed - coalesce(kept, 0L))"
        return joined.selectExpr(*by, f"map_concat(rules, {repeated}) AS refused")

    def backfill_long(
        self,
        dumps: DataFrame,
        days: Sequence[dt.date | str] | None = None,
        extra: str = "refuse",
    ) -> DataFrame:
        """Take in many days at once from one long table with a ``day`` column.

        The cleaned table is written once, by day; one job makes the whole log
        of it. Name the ``days`` if some dump is empty. Rows without a day are
        refused. Only for a store that holds nothing yet.
        """
        if self._committed():
            raise ValueError("backfill_long fills an empty store; use ingest")
        if dict(dumps.dtypes).get(DAY) != "date":
            raise TypeError(f"the long table needs a column {DAY} of type date")
        with_day = T.StructType([*self.schema.fields, T.StructField(DAY, T.DateType())])
        dated = conform(dumps, with_day, [DAY, *self.keys], extra)
        given = dated.withColumn(DAY, F.expr(f"coalesce({DAY}, raise_error('a row of the long table has no day'))"))
        rows = self._cleaned(given, [DAY, *self.keys])
        cleaned = scratch_folder(self.spark)
        try:
            rows.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(cleaned)
            return self._backfill_cleaned(cleaned, given, days)
        finally:
            remove(self.spark, cleaned)

    def _backfill_cleaned(self, cleaned: str, given: DataFrame, days) -> DataFrame:
        found = {as_day(n.removeprefix("day=")) for n in folders(self.spark, cleaned) if n.startswith("day=")}
        known = sorted(found if days is None else {as_day(d) for d in days})
        if not known:
            raise ValueError("no days to ingest")
        if found - set(known):
            raise ValueError(f"days in the table but not in the list: {sorted(found - set(known))}")
        with_day = T.StructType([*self.schema.fields, T.StructField(DAY, T.DateType())])
        rows = self.spark.read.schema(with_day).parquet(cleaned)
        version = uuid.uuid4().hex
        log = history.reverse_log(rows, self.keys, known).select(
            *log_schema(self.schema).fieldNames(), F.lit(version).alias("__attempt")
        )
        # Collects each day's rows into few files, and splits the big days.
        regrouped = log.hint("rebalance", F.col(DAY))
        writer = regrouped.write.mode("append").partitionBy(DAY, "__attempt")
        writer.parquet(f"{self.root}/diff")
        newest = rows.filter(F.col(DAY) == F.lit(known[-1])).drop(DAY)
        size = folder_bytes(self.spark, f"{cleaned}/day={known[-1].isoformat()}")
        commit = Commit(1, version, self._bucket_count(size, None))
        spread = newest.repartition(commit.buckets, *[F.col(k) for k in idents(self.keys)])
        self._write_snapshot(known[-1], commit, spread)
        if self.sketches:
            earlier = rows.filter(F.col(DAY) < F.lit(known[-1]))
            found = day_sketches(earlier, self.keys, *self.sketches, by=[DAY])
            found = found.withColumn("__attempt", F.lit(version))
            found.write.mode("append").partitionBy(DAY, "__attempt").parquet(f"{self.root}/sketch")

        commits = dict.fromkeys(known, commit)
        listed = self.spark.createDataFrame([(d,) for d in known], f"{DAY} date")
        counts = changes.log_summary(self._read_log(commits))
        refused = self._refused(given, rows, [DAY])
        every = listed.join(counts, DAY, "left").na.fill(0).join(refused, DAY, "left")
        self._write_summary(1, every, commits)
        return self.summaries()

    def _bucket_count(self, size: int, before: Commit | None) -> int:
        """Buckets for a snapshot of about ``size`` bytes."""
        if self.buckets:
            return self.buckets
        wanted = max(1, -(-size // BUCKET_BYTES))
        most = int(self.spark.conf.get(MAX_BUCKETS))
        if wanted > most:
            raise ValueError(f"{size} bytes need {wanted} buckets; raise {MAX_BUCKETS}, which is {most}")
        # Equal counts are what spares the next comparison its shuffle.
        had = before.buckets if before else 0
        return had if had <= 2 * wanted and wanted <= 2 * had else wanted

    def _write_snapshot(self, day: dt.date, commit: Commit, rows: DataFrame) -> None:
        """Deduplicated rows go straight from their shuffle into their buckets.

        The session's partition counts are set for the time of the write, so
        one session should not run other queries meanwhile.
        """
        settings = {
            "spark.sql.shuffle.partitions": str(commit.buckets),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(commit.buckets),
        }
        conf = self.spark.conf
        saved = {name: conf.get(name, None) for name in settings}
        try:
            for name, value in settings.items():
                conf.set(name, value)
            write_bucketed(rows, self._path("snapshot", day, commit.version), self.keys, commit.buckets)
        finally:
            for name, value in saved.items():
                if value is None:
                    conf.unset(name)
                else:
                    conf.set(name, value)
        if self.digests:
            path = self._path("snapshot", day, commit.version)
            written = self.spark.read.schema(self.schema).parquet(path)
            found = digests.digests(written, self.keys, commit.buckets, self.digests)
            found.write.mode("overwrite").parquet(f"{self._path('digest', day, commit.version)}/parts={self.digests}")
        if self.sketches:
            written = self.spark.read.schema(self.schema).parquet(self._path("snapshot", day, commit.version))
            found = day_sketches(written, self.keys, *self.sketches)
            found.write.mode("overwrite").parquet(self._path("sketch", day, commit.version))

    def _write_summary(self, number: int, counts: DataFrame, commits: Commits) -> None:
        named = {DAY: list(commits), "version": [c.version for c in commits.values()]}
        rows = list(zip(named[DAY], named["version"], [c.buckets for c in commits.values()]))
        told = self.spark.createDataFrame(rows, f"{DAY} date, version string, buckets int")
        (
            counts.join(F.broadcast(told), DAY)
            .withColumn("commit", F.lit(number).cast("long"))
            .select(*SUMMARY_SCHEMA.fieldNames())
            # One file, so that the commit is one rename.
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.root}/summary/c={number:010d}")
        )

    def compact(self) -> list[tuple[dt.date, dt.date]]:
        """Merge the deltas of past days by twos, fours, eights and so on; returns the new spans.

        ``as_of`` then replays a few deltas per level instead of one per day.
        The log stays as it is. Run it as often as wanted, after ingests: it
        merges only what is new, and leaves out the newest day, which may still
        be redone.
        """
        committed = self._committed()
        return levels.compact(
            self.spark, self.root, self.schema, self.keys, list(committed), lambda days: self._read_days(committed, days)
        )

    def vacuum(self, keep: int | None = None) -> None:
        """Remove what no longer counts: failed and replaced attempts, and all
        snapshots but the newest ``keep`` (by default the store's), which the
        log covers. Frames that read them are void from then on.
        """
        keep = self.keep if keep is None else keep
        if keep < 2:
            raise ValueError("keep at least two snapshots: a re-run needs the one before")
        committed = self._committed()
        kept = set(self._stored_snapshots(committed)[-keep:])
        for part in ("snapshot", "digest", "sketch", "diff"):
            for name in folders(self.spark, f"{self.root}/{part}"):
                if not name.startswith("day="):
                    continue
                day, folder = as_day(name.removeprefix("day=")), f"{self.root}/{part}/{name}"
                counts = day in committed and (part in {"diff", "sketch"} or day in kept)
                for version in folders(self.spark, folder):
                    if not counts or version != f"__attempt={committed[day].version}":
                        remove(self.spark, f"{folder}/{version}")
                if not folders(self.spark, folder):
                    remove(self.spark, folder)
        merged = {levels.span_name(s): v for s, v in levels.merged_spans(self.spark, self.root).items()}
        for name in folders(self.spark, f"{self.root}/merged"):
            folder = f"{self.root}/merged/{name}"
            for version in folders(self.spark, folder):
                if version != f"__attempt={merged.get(name.removeprefix('span='))}":
                    remove(self.spark, f"{folder}/{version}")


def _estimated_bytes(rows: DataFrame) -> int:
    """The planner's estimate; of a plain scan, the bytes of its files.

    Where the planner has nothing to go by, the rows are counted.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    unknown = 1 << 60
    return size if size < unknown else rows.count() * 16 * len(rows.columns)


def _nodes(rows: DataFrame) -> list[str]:
    """Names of all steps of the optimized plan."""
    waiting, names = [rows._jdf.queryExecution().optimizedPlan()], []
    while waiting:
        node = waiting.pop()
        names.append(node.nodeName())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return names


def _plain_scan(rows: DataFrame) -> bool:
    """Whether the rows are those of files, filtered and projected at most."""
    return all(n in {"Project", "Filter"} or n.startswith(("Relation", "LogicalRelation")) for n in _nodes(rows))


def _may_grow(rows: DataFrame) -> bool:
    """Whether a step may give more than the planner expects: it takes each row to give one."""
    return not set(_nodes(rows)).isdisjoint({"Generate", "Expand", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"})
