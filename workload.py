"""The library on the test tables: what `queries()` runs and what it must equal.

The tables hold no daily dumps, so three stand-ins are derived from whole
tables:

* daily dumps from `events`, one for each day with events: each user's last
  event of the day; a user whose last event is an error is absent;
* yearly dumps from `orders`: each customer's last order of a year;
* a pair of snapshots from `lineitem`: the last returned and the last kept
  line of each part and supplier.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.functions import passes
from tidemark.plans import scratch_folder

MID, LATEST, BEFORE = "2024-01-15", "2024-12-31", "2023-12-31"
USER = ["user_id"]
PAIR = ["l_partkey", "l_suppkey"]
PAIR_COLUMNS = ["l_linenumber", "l_linestatus"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Stand-ins


def daily(spark, sf) -> DataFrame:
    events = table(spark, sf, "events").selectExpr(
        "CAST(ts AS DATE) AS day", "user_id", "event_type", "value", "ts", "event_id"
    )
    last = tm.dedupe(events, ["day", "user_id"], prefer=["ts DESC", "event_id DESC"])
    return last.filter("event_type <> 'error'").select("day", "user_id", "event_type", "value")


def last_dump(spark, sf) -> DataFrame:
    last_day = table(spark, sf, "events").selectExpr("CAST(max(ts) AS DATE) AS day")
    return daily(spark, sf).join(F.broadcast(last_day), "day", "left_semi").drop("day")


def daily_days(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr("CAST(ts AS DATE) AS day")


def daily_log(spark, sf) -> DataFrame:
    return tm.reverse_log(daily(spark, sf), USER, daily_days(spark, sf))


def yearly(orders: DataFrame) -> DataFrame:
    dated = orders.selectExpr(
        "make_date(year(o_orderdate), 12, 31) AS day",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        "o_orderdate",
        "o_orderkey",
    )
    last = tm.dedupe(dated, ["day", "o_custkey"], prefer=["o_orderdate DESC", "o_orderkey DESC"])
    return last.drop("o_orderdate", "o_orderkey")


def pair(spark, sf) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").select(
        *PAIR, *PAIR_COLUMNS, "l_returnflag", "l_shipdate", "l_orderkey"
    )
    prefer = ["l_shipdate DESC", "l_orderkey DESC", "l_linenumber DESC"]
    return tuple(
        tm.dedupe(lines.filter(which), PAIR, prefer).select(*PAIR, *PAIR_COLUMNS)
        for which in ("l_returnflag = 'R'", "l_returnflag <> 'R'")
    )


def pair_changes(spark, sf) -> DataFrame:
    return tm.compare(*pair(spark, sf), PAIR, unique_keys=True)


# Stores on the stand-ins


def yearly_store(spark, sf) -> tm.HistoryStore:
    """One ingest per year, oldest first."""
    orders = table(spark, sf, "orders")
    schema = yearly(orders).drop("day").schema
    store = tm.HistoryStore(spark, scratch_folder(spark), schema, ["o_custkey"])
    years = [r[0] for r in orders.selectExpr("year(o_orderdate)").distinct().collect()]
    dumps = {}
    for year in sorted(years):
        in_year = f"o_orderdate >= '{year}-01-01' AND o_orderdate < '{year + 1}-01-01'"
        dumps[dt.date(year, 12, 31)] = yearly(orders.filter(in_year)).drop("day")
    store.backfill(dumps)
    return store


def daily_store(spark, sf) -> tm.HistoryStore:
    """All days in one job."""
    dumps = daily(spark, sf)
    store = tm.HistoryStore(spark, scratch_folder(spark), dumps.drop("day").schema, USER)
    store.backfill_long(dumps, [r[0] for r in daily_days(spark, sf).distinct().collect()])
    return store


# Queries


def clean_keys(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.filter(passes(tm.key_rules(pages.schema, ["url"])))


def clean_rows(spark, sf):
    documents = table(spark, sf, "documents").select("source", "lang", "doc_id")
    return tm.clean(documents, ["source", "lang"])


def rejected_keys(spark, sf):
    documents = table(spark, sf, "documents").select("text")
    return tm.rejections(documents, tm.key_rules(documents.schema, ["text"]))


def dedupe_by_key(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return tm.dedupe(events, USER, prefer=["ts DESC", "event_id DESC"])


def csv_dump(spark, sf):
    customer = table(spark, sf, "customer")
    folder = scratch_folder(spark)
    customer.write.option("header", True).option("sep", ";").csv(folder)
    return tm.read_dump(spark, folder, customer.schema)


def row_hash(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", tm.row_hash(documents.columns).alias("hash"))


def row_hash_named(spark, sf):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", tm.row_hash_named(columns).alias("hash"))


def diff_added(spark, sf):
    return tm.added_rows(pair_changes(spark, sf), PAIR)


def diff_removed(spark, sf):
    return tm.removed_rows(pair_changes(spark, sf), PAIR)


def diff_modified(spark, sf):
    short = {"number": "l_linenumber", "status": "l_linestatus"}
    return tm.modified_rows(pair_changes(spark, sf), PAIR, short)


def diff_classified(spark, sf):
    return pair_changes(spark, sf)


def diff_summary(spark, sf):
    return tm.change_summary(pair_changes(spark, sf))


def diff_sample(spark, sf):
    return tm.change_sample(diff_removed(spark, sf), PAIR, 10)


def diff_repeated_keys(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select(*keys, *PAIR, "l_returnflag")
    sides = [
        lines.filter(which).drop("l_returnflag")
        for which in ("l_returnflag = 'R'", "l_returnflag <> 'R'")
    ]
    return tm.compare(*sides, keys)


def reverse_log(spark, sf):
    return daily_log(spark, sf)


def reverse_log_counts(spark, sf):
    return tm.log_summary(daily_log(spark, sf))


def reverse_log_yearly(spark, sf):
    orders = table(spark, sf, "orders")
    days = orders.selectExpr("make_date(year(o_orderdate), 12, 31) AS day")
    return tm.reverse_log(yearly(orders), ["o_custkey"], days)


def as_of_mid(spark, sf):
    return tm.as_of(last_dump(spark, sf), daily_log(spark, sf), MID, USER)


def as_of_latest(spark, sf):
    return tm.as_of(last_dump(spark, sf), daily_log(spark, sf), LATEST, USER)


def as_of_before_first(spark, sf):
    return tm.as_of(last_dump(spark, sf), daily_log(spark, sf), BEFORE, USER)


def as_of_many(spark, sf):
    first = dt.date.fromisoformat(BEFORE)
    days = [first + dt.timedelta(n) for n in range(40)]
    return tm.as_of_many(last_dump(spark, sf), daily_log(spark, sf), days, USER)


def report_metrics(spark, sf):
    return tm.snapshot_report(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")


def snapshot_metrics(spark, sf):
    orders = table(spark, sf, "orders")
    return tm.snapshot_metrics(orders, ["o_orderkey"], "o_custkey", "o_orderpriority")


def compare_metrics(spark, sf):
    return tm.compare_metrics(
        *pair(spark, sf), PAIR, commune="l_partkey", street="l_suppkey", unique_keys=True
    )


def approximate_metrics(spark, sf):
    """Whether each estimate is within a tenth of the exact count."""
    orders = table(spark, sf, "orders")
    arguments = (orders, ["o_orderkey"], "o_custkey", "o_orderpriority")
    sides = [
        metrics(*arguments).unpivot([], tm.operators.metrics.METRICS, "metric", name)
        for metrics, name in (
            (tm.approximate_metrics, "estimate"),
            (tm.snapshot_metrics, "exact"),
        )
    ]
    return sides[0].join(sides[1], "metric").selectExpr(
        "metric", "abs(estimate - exact) <= 0.1 * exact AS close"
    )


def reconcile_extra(spark, sf):
    return tm.extra_keys(*pair(spark, sf), PAIR)


def reconcile_missing(spark, sf):
    return tm.missing_keys(*pair(spark, sf), PAIR)


def reconcile_rebuilt(spark, sf):
    truth = daily(spark, sf).filter(f"day = DATE'{MID}'").drop("day")
    return tm.reconcile_metrics(
        as_of_mid(spark, sf), truth, USER, commune="event_type", street="value", unique_keys=True
    )


def rows_per_prefix(spark, sf):
    return tm.rows_per_prefix(table(spark, sf, "orders"), "o_custkey")


def ingest_log(spark, sf):
    return yearly_store(spark, sf).log()


def ingest_summaries(spark, sf):
    return yearly_store(spark, sf).summaries()


def store_as_of(spark, sf):
    return yearly_store(spark, sf).as_of("1998-06-30")


def store_report(spark, sf):
    return yearly_store(spark, sf).report("o_orderpriority", "o_totalprice")


def backfill_log(spark, sf):
    return daily_store(spark, sf).log()


def backfill_as_of_many(spark, sf):
    first = dt.date.fromisoformat(BEFORE)
    return daily_store(spark, sf).as_of_many([first + dt.timedelta(n) for n in range(40)])


# Nulls and dirt, made by rule from whole tables


def customer_pair(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two states of `customer`; balances and keys are null for some rows."""
    customer = table(spark, sf, "customer")
    sides = []
    for absent, null_balance in ((7, 11), (5, 13)):
        sides.append(
            customer.filter(f"c_custkey % {absent} <> 0").selectExpr(
                "if(c_custkey % 19 = 0, NULL, c_custkey) AS c_custkey",
                f"if(c_custkey % {null_balance} = 0, NULL, c_acctbal) AS c_acctbal",
                "c_mktsegment",
            )
        )
    return tuple(sides)


def diff_null_values(spark, sf):
    sides = [side.filter("c_custkey IS NOT NULL") for side in customer_pair(spark, sf)]
    return tm.compare(*sides, ["c_custkey"], unique_keys=True)


def diff_null_keys(spark, sf):
    return tm.compare(*customer_pair(spark, sf), ["c_custkey"])


def diff_hot_key(spark, sf):
    """Keyed by event type: a few keys hold all rows."""
    events = table(spark, sf, "events").select("event_type", "user_id", "value")
    return tm.change_summary(
        tm.compare(events.filter("user_id % 3 <> 0"), events.filter("user_id % 5 <> 0"), ["event_type"])
    )


def clean_null_keys(spark, sf):
    documents = table(spark, sf, "documents").selectExpr(
        "if(doc_id % 3 = 0, NULL, source) AS source", "lang", "doc_id"
    )
    return tm.clean(documents, ["source", "lang"])


def report_null_codes(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "nullif(c_nationkey, 3) AS nation", "nullif(c_mktsegment, 'BUILDING') AS segment"
    )
    return tm.snapshot_report(customer, "nation", "segment")


def row_hash_nulls(spark, sf):
    columns = ["c_name", "c_nationkey", "c_mktsegment"]
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "nullif(c_nationkey, 3) AS c_nationkey",
        "if(c_custkey % 4 = 0, NULL, c_mktsegment) AS c_mktsegment",
    )
    return customer.select("c_custkey", tm.row_hash(columns).alias("hash"))


def csv_malformed(spark, sf):
    """Every tenth line has a code that is no number."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    broken = customer.withColumn("c_nationkey", F.expr("if(c_custkey % 10 = 0, '12A', string(c_nationkey))"))
    folder = scratch_folder(spark)
    broken.write.option("header", True).option("sep", ";").csv(folder)
    read = tm.read_dump(spark, folder, customer.schema, mark=True)
    return read.selectExpr("c_custkey", "_malformed IS NOT NULL AS malformed")


def ingest_rejections(spark, sf):
    dump = table(spark, sf, "customer").selectExpr(
        """CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN concat('a@', c_custkey)
           WHEN c_custkey % 13 = 0 THEN repeat('k', 50) WHEN c_custkey % 7 = 0 THEN 'shared'
           ELSE string(c_custkey) END AS code""",
        "c_custkey",
    )
    store = tm.HistoryStore(spark, scratch_folder(spark), dump.schema, ["code"])
    store.ingest("2025-01-01", dump)
    return store.refusals().select("rule", "refused")


def redo_day(spark, sf):
    """Every year; the last is redone with a bad dump, then from the store's own rows."""
    orders = table(spark, sf, "orders")
    schema = yearly(orders).drop("day").schema
    store = tm.HistoryStore(spark, scratch_folder(spark), schema, ["o_custkey"])
    years = sorted(r[0] for r in orders.selectExpr("year(o_orderdate)").distinct().collect())
    for year in years:
        in_year = f"o_orderdate >= '{year}-01-01' AND o_orderdate < '{year + 1}-01-01'"
        store.ingest(dt.date(year, 12, 31), yearly(orders.filter(in_year)).drop("day"))
    last = dt.date(years[-1], 12, 31)
    try:
        store.ingest(last, store.snapshot().withColumn("surplus", F.lit(1)))
    except ValueError:
        pass
    store.ingest(last, store.snapshot().filter("o_custkey % 3 <> 0"))
    return store.log()


def rebuild_verified(spark, sf):
    """Rebuild a day, write it, find its original dump and compare the two."""
    day = "1996-12-31"
    truth = yearly(table(spark, sf, "orders")).filter(f"day = DATE'{day}'").drop("day")
    folder = scratch_folder(spark)
    truth.write.option("header", True).option("sep", ";").csv(f"{folder}/dump-{day}/adresses.csv")
    found = tm.rebuild(
        yearly_store(spark, sf), day, f"{folder}/rebuilt", folder, "o_orderstatus", "o_orderpriority"
    )
    return found.metrics


def diff_folders(spark, sf):
    folder = scratch_folder(spark)
    paths = [f"{folder}/before", f"{folder}/after"]
    for side, path in zip(pair(spark, sf), paths):
        side.write.parquet(path)
    short = {"number": "l_linenumber", "status": "l_linestatus"}
    return tm.diff(spark, *paths, PAIR, PAIR_COLUMNS, short, "l_partkey", "l_suppkey").modified


# Histories as wholes: merged days, digests, versions


def compacted_as_of(spark, sf):
    """The first day, from deltas of several days each."""
    store = daily_store(spark, sf)
    store.compact()
    return store.as_of(store.days()[0])


def compacted_as_of_mid(spark, sf):
    store = daily_store(spark, sf)
    store.compact()
    return store.as_of(MID)


def last_orders(orders: DataFrame) -> DataFrame:
    """Each customer's last order."""
    last = tm.dedupe(orders, ["o_custkey"], prefer=["o_orderdate DESC", "o_orderkey DESC"])
    return last.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def diff_stored_days(spark, sf):
    """Customers' last orders with and without the last day: most key ranges stay as they were."""
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderdate").alias("last"))
    days = {
        "2025-01-01": orders.join(F.broadcast(last), F.col("o_orderdate") < F.col("last"), "left_semi"),
        "2025-01-02": orders,
    }
    dumps = {day: last_orders(rows) for day, rows in days.items()}
    schema = dumps["2025-01-02"].schema
    store = tm.HistoryStore(spark, scratch_folder(spark), schema, ["o_custkey"], buckets=64, digests=16)
    store.backfill(dumps)
    return store.diff(*dumps)


def point_in_time_state(spark, sf):
    """Each event with its user's row in the dump of its own day."""
    facts = table(spark, sf, "events").selectExpr("event_id", "user_id", "CAST(ts AS DATE) AS on_day")
    known = tm.versions(last_dump(spark, sf), daily_log(spark, sf), USER)
    return tm.point_in_time(facts, known, USER, "on_day", present="present")


def _known(spark, sf, which: str, key: str) -> DataFrame:
    """Events as versions; of several at one time the one with the highest id."""
    chosen = table(spark, sf, "events").filter(which)
    last = tm.dedupe(chosen, [key, "ts"], prefer=["event_id DESC"])
    return last.selectExpr(key, "ts AS since", "event_id AS last_id", "value AS last_value")


def point_in_time_last(spark, sf):
    """Each event with its user's last purchase up to then."""
    facts = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return tm.point_in_time(facts, _known(spark, sf, "event_type = 'purchase'", "user_id"), USER, "ts")


def point_in_time_hot(spark, sf):
    """Each event with the last one of its type above 100 up to then: a few keys hold all rows."""
    facts = table(spark, sf, "events").select("event_id", "event_type", "ts")
    known = _known(spark, sf, "value > 100", "event_type")
    return tm.point_in_time(facts, known, ["event_type"], "ts", most=500, ranges=16)


def _stored_sketches(spark, sides, keys, buckets: int, cells: int) -> list[DataFrame]:
    stored = []
    for side in sides:
        folder = scratch_folder(spark)
        tm.key_sketch(side, keys, buckets, cells, unique_keys=True).write.parquet(folder)
        stored.append(spark.read.parquet(folder))
    return stored


def reconcile_by_sketch(spark, sf):
    """Orders without the last ten days against orders without the first ten."""
    orders = table(spark, sf, "orders")
    ends = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    sides = [
        orders.join(F.broadcast(ends), F.expr(when), "left_semi").select("o_orderkey")
        for when in ("o_orderdate < last - INTERVAL 10 DAYS", "o_orderdate > first + INTERVAL 10 DAYS")
    ]
    sketches = _stored_sketches(spark, sides, ["o_orderkey"], 256, 96)
    return tm.reconcile_keys(*sides, ["o_orderkey"], sketches, 256, 96)


def reconcile_by_key(spark, sf):
    """Sides so unlike that the sketches cannot tell: every bucket is compared key by key."""
    sides = pair(spark, sf)
    sketches = _stored_sketches(spark, sides, PAIR, 16, 30)
    return tm.reconcile_keys(*sides, PAIR, sketches, 16, 30)


def range_report(spark, sf):
    """Three years' distinct customers, priorities and prices out of their sketches, beside the exact counts."""
    orders = yearly(table(spark, sf, "orders"))
    days = [r[0] for r in orders.select("day").distinct().collect()]
    store = tm.HistoryStore(
        spark, scratch_folder(spark), orders.drop("day").schema, ["o_custkey"], sketches=("o_orderpriority", "o_totalprice")
    )
    store.backfill_long(orders, days)
    names = tm.operators.metrics.METRICS
    united = store.range_report("1996-12-31", "1998-12-31").unpivot([], names, "metric", "estimate")
    rows = orders.filter("day BETWEEN DATE'1996-12-31' AND DATE'1998-12-31'")
    exact = tm.snapshot_metrics(rows, ["o_custkey"], "o_orderpriority", "o_totalprice")
    both = united.join(exact.unpivot([], names, "metric", "exact"), "metric")
    # Four standard deviations of a united sketch.
    return both.selectExpr("metric", "exact", "abs(estimate - exact) <= 4 * 1.04 / 64 * exact AS close")


def arriving_dumps(spark, sf):
    """Yearly dumps that come into a folder in two lots; the last batch is run twice."""
    orders = table(spark, sf, "orders")
    schema = yearly(orders).drop("day").schema
    store = tm.HistoryStore(spark, scratch_folder(spark), schema, ["o_custkey"])
    years = sorted(r[0] for r in orders.selectExpr("year(o_orderdate)").distinct().collect())
    folder = scratch_folder(spark)
    for lot in (years[: len(years) // 2], years[len(years) // 2 :]):
        for year in lot:
            in_year = f"o_orderdate >= '{year}-01-01' AND o_orderdate < '{year + 1}-01-01'"
            dump = yearly(orders.filter(in_year)).drop("day").coalesce(1)
            dump.write.option("header", True).option("sep", ";").csv(f"{folder}/dump-{year}-12-31/adresses.csv")
        tm.streaming.ingest_arrivals(store, folder)
    last = tm.streaming.arrivals(store).orderBy(F.desc("day")).first()
    tm.streaming.take_in(store, last["files"], last["batch"])
    return store.log()


def rebuild_differences(spark, sf):
    """A rebuilt day against an original that lacks some rows, has others, and differs in a column."""
    day = "1996-12-31"
    rows = yearly(table(spark, sf, "orders")).filter(f"day = DATE'{day}'").drop("day")
    truth = rows.filter("o_custkey % 7 <> 0").withColumn(
        "o_orderstatus", F.expr("if(o_custkey % 13 = 0, 'X', o_orderstatus)")
    )
    more = rows.filter("o_custkey % 11 = 0 AND o_custkey > 0").withColumn("o_custkey", -F.col("o_custkey"))
    folder = scratch_folder(spark)
    written = truth.unionByName(more).write.option("header", True).option("sep", ";")
    written.csv(f"{folder}/dump-{day}/adresses.csv")
    found = tm.rebuild(
        yearly_store(spark, sf), day, f"{folder}/rebuilt", folder, "o_orderstatus", "o_orderpriority"
    )
    parts = [
        found.extra.selectExpr("'extra' AS kind", "o_custkey"),
        found.missing.selectExpr("'missing' AS kind", "o_custkey"),
        found.changes.selectExpr("change AS kind", "o_custkey"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def diff_folders_rest(spark, sf):
    """What `diff` tells besides modified rows, of folders whose columns differ."""
    folder = scratch_folder(spark)
    before, after = pair(spark, sf)
    paths = [f"{folder}/before", f"{folder}/after"]
    before.withColumn("only_before", F.lit("x")).write.parquet(paths[0])
    after.withColumn("l_linenumber", F.col("l_linenumber").cast("decimal(12,0)")).write.parquet(paths[1])
    short = {"number": "l_linenumber", "status": "l_linestatus"}
    found = tm.diff(spark, *paths, PAIR, ["l_linestatus"], short, "l_partkey", "l_suppkey", unique_keys=True)
    counts = found.summary.unpivot([], ["inserts", "updates", "deletes", "total"], "what", "n")
    listed = [
        counts.selectExpr("what", "CAST(n AS STRING) AS value"),
        found.columns.selectExpr("column AS what", "concat_ws('/', before_type, after_type) AS value"),
        *[
            rows.selectExpr(f"'{kind}' AS what", "concat_ws('/', l_partkey, l_suppkey, l_linestatus) AS value")
            for kind, rows in (("removed", found.removed), ("added", found.added))
        ],
    ]
    return listed[0].unionByName(listed[1]).unionByName(listed[2]).unionByName(listed[3])


def _thin_daily_log(spark, sf) -> DataFrame:
    """The daily log with nothing but old values that changed, as written and read again."""
    folder = scratch_folder(spark)
    tm.thin_log(daily_log(spark, sf), last_dump(spark, sf), USER).write.parquet(folder)
    return spark.read.parquet(folder)


def thin_as_of(spark, sf):
    return tm.as_of_thin(last_dump(spark, sf), _thin_daily_log(spark, sf), MID, USER)


def thin_log_restored(spark, sf):
    return tm.dense_log(_thin_daily_log(spark, sf), last_dump(spark, sf), USER)


def changes_per_column(spark, sf):
    """How often each column of the yearly dumps changed, by year."""
    dumps = yearly(table(spark, sf, "orders"))
    last = F.broadcast(dumps.agg(F.max("day").alias("day")))
    snapshot = dumps.join(last, "day", "left_semi").drop("day")
    keys = ["o_custkey"]
    thin = tm.thin_log(tm.reverse_log(dumps, keys), snapshot, keys)
    return tm.column_changes(thin, keys, ["day"])


def _frequent(spark, rows: DataFrame, items: list[str], per: int) -> DataFrame:
    """By sketches of each day, as written and read again."""
    folder = scratch_folder(spark)
    tm.frequency_sketches(rows, items, per, ["day"]).write.parquet(folder)
    return tm.frequent_items(rows, spark.read.parquet(folder), items, per)


def frequent_changed_keys(spark, sf):
    """Users with one in 140 of all changes, or more."""
    return _frequent(spark, daily_log(spark, sf), USER, 140)


def frequent_changes(spark, sf):
    """Kinds of change, with the old type, that make up one in 20, or more."""
    return _frequent(spark, daily_log(spark, sf), ["action", "event_type"], 20)


QUERIES = {
    f.__name__: f
    for f in (
        clean_keys,
        clean_rows,
        rejected_keys,
        dedupe_by_key,
        csv_dump,
        row_hash,
        row_hash_named,
        diff_added,
        diff_removed,
        diff_modified,
        diff_classified,
        diff_summary,
        diff_sample,
        diff_repeated_keys,
        reverse_log,
        reverse_log_counts,
        reverse_log_yearly,
        as_of_mid,
        as_of_latest,
        as_of_before_first,
        as_of_many,
        report_metrics,
        snapshot_metrics,
        compare_metrics,
        approximate_metrics,
        reconcile_extra,
        reconcile_missing,
        reconcile_rebuilt,
        rows_per_prefix,
        ingest_log,
        ingest_summaries,
        store_as_of,
        store_report,
        backfill_log,
        backfill_as_of_many,
        diff_null_values,
        diff_null_keys,
        diff_hot_key,
        clean_null_keys,
        report_null_codes,
        row_hash_nulls,
        csv_malformed,
        ingest_rejections,
        redo_day,
        rebuild_verified,
        diff_folders,
        compacted_as_of,
        compacted_as_of_mid,
        diff_stored_days,
        point_in_time_state,
        point_in_time_last,
        point_in_time_hot,
        reconcile_by_sketch,
        reconcile_by_key,
        range_report,
        arriving_dumps,
        rebuild_differences,
        diff_folders_rest,
        thin_as_of,
        thin_log_restored,
        changes_per_column,
        frequent_changed_keys,
        frequent_changes,
    )
}

# The same results in DuckDB's SQL. Rebuilt days are compared with the dumps
# themselves, not with a second copy of the rebuilding.

DAILY = """
last_event AS (
    SELECT CAST(ts AS DATE) AS day, user_id, event_type, value,
           row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events),
daily AS (
    SELECT day, user_id, event_type, value FROM last_event
    WHERE rn = 1 AND event_type <> 'error')"""

YEARLY = """
last_order AS (
    SELECT make_date(year(o_orderdate), 12, 31) AS day, o_custkey, o_orderstatus, o_totalprice,
           o_orderpriority,
           row_number() OVER (PARTITION BY year(o_orderdate), o_custkey
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders),
yearly AS (SELECT * EXCLUDE (rn) FROM last_order WHERE rn = 1)"""

PAIRED = """
line AS (
    SELECT l_partkey, l_suppkey, l_linenumber, l_linestatus, l_returnflag = 'R' AS returned,
           row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_returnflag = 'R'
                              ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                                       l_linestatus, l_returnflag) AS rn
    FROM lineitem),
a AS (SELECT * EXCLUDE (rn, returned) FROM line WHERE rn = 1 AND returned),
b AS (SELECT * EXCLUDE (rn, returned) FROM line WHERE rn = 1 AND NOT returned)"""

CLASSIFIED = f"""{PAIRED},
changes AS (
    SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey,
           coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
           CASE WHEN a.l_partkey IS NULL THEN 'added'
                WHEN b.l_partkey IS NULL THEN 'removed'
                WHEN a.l_linenumber IS DISTINCT FROM b.l_linenumber
                  OR a.l_linestatus IS DISTINCT FROM b.l_linestatus THEN 'modified' END AS change,
           a.l_linenumber AS old_l_linenumber, a.l_linestatus AS old_l_linestatus,
           b.l_linenumber AS new_l_linenumber, b.l_linestatus AS new_l_linestatus
    FROM a FULL OUTER JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)"""


def _log_sql(dumps: str, source: str, key: str, columns: list[str]) -> str:
    """The reverse log of a long table by joining each dump with the one before.

    The days are those of ``source``, as a dump may be empty.
    """
    images = ", ".join(f"CASE WHEN p.{key} IS NULL THEN t.{c} ELSE p.{c} END AS {c}" for c in columns)
    differ = " OR ".join(f"t.{c} IS DISTINCT FROM p.{c}" for c in columns)
    return f"""
days AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM {source})),
earlier AS (SELECT d.day AS at, x.* FROM {dumps} x JOIN days d ON x.day = d.before),
log AS (
    SELECT coalesce(t.{key}, p.{key}) AS {key}, {images},
           CASE WHEN p.{key} IS NULL THEN 'DELETE' WHEN t.{key} IS NULL THEN 'INSERT'
                WHEN {differ} THEN 'UPDATE' END AS action,
           coalesce(t.day, p.at) AS day
    FROM {dumps} t FULL OUTER JOIN earlier p ON t.{key} = p.{key} AND t.day = p.at)"""


DAILY_LOG = DAILY + "," + _log_sql("daily", "last_event", "user_id", ["event_type", "value"])
YEARLY_LOG = (
    YEARLY
    + ","
    + _log_sql("yearly", "last_order", "o_custkey", ["o_orderstatus", "o_totalprice", "o_orderpriority"])
)
LOG_ROWS = "SELECT * FROM log WHERE action IS NOT NULL"
SUMMARIES = """SELECT day, count(*) FILTER (action = 'DELETE') AS inserts,
       count(*) FILTER (action = 'UPDATE') AS updates,
       count(*) FILTER (action = 'INSERT') AS deletes,
       count(action) AS total FROM log GROUP BY day"""
MANY_DAYS = f"""SELECT CAST(w.as_of AS DATE) AS as_of, user_id, event_type, value
FROM (SELECT unnest(generate_series(DATE '{BEFORE}', DATE '{BEFORE}' + 39, INTERVAL 1 DAY)) AS as_of) w
JOIN daily ON day = (SELECT max(d.day) FROM last_event d WHERE d.day <= w.as_of)"""
REPORT = """SELECT count(*) AS addresses,
       count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS communes,
       count(DISTINCT {s}) + coalesce(max(CASE WHEN {s} IS NULL THEN 1 ELSE 0 END), 0) AS streets,
       count(DISTINCT substring(CAST({c} AS VARCHAR), 1, 2))
           + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS departments
FROM {t}"""


def _metrics_sql(relation: str, keys: str, commune: str, street: str) -> str:
    counts = {
        "addresses": keys,
        "communes": commune,
        "streets": street,
        "departments": f"substring(CAST({commune} AS VARCHAR), 1, 2)",
    }
    listed = ", ".join(f"count(DISTINCT {x}) AS {name}" for name, x in counts.items())
    return f"SELECT {listed} FROM {relation}"


def _unpivot(sql: str, value: str) -> str:
    return f"(UNPIVOT ({sql}) ON addresses, communes, streets, departments INTO NAME metric VALUE {value})"


_CUSTOMER = """SELECT CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey END AS c_custkey,
        CASE WHEN c_custkey % {} = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % {} <> 0"""
_CUSTOMERS = f"""
a AS ({_CUSTOMER.format(11, 7)}), b AS ({_CUSTOMER.format(13, 5)}),
sided_a AS (SELECT *, true AS here FROM a), sided_b AS (SELECT *, true AS here FROM b),
customer_changes AS (
    SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
           CASE WHEN a.here IS NULL THEN 'added' WHEN b.here IS NULL THEN 'removed'
                WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal
                  OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN 'modified' END AS change,
           a.c_acctbal AS old_c_acctbal, a.c_mktsegment AS old_c_mktsegment,
           b.c_acctbal AS new_c_acctbal, b.c_mktsegment AS new_c_mktsegment
    FROM sided_a a FULL OUTER JOIN sided_b b ON a.c_custkey = b.c_custkey)"""
_PAIR_METRICS = [
    _unpivot(_metrics_sql(side, "(l_partkey, l_suppkey)", "l_partkey", "l_suppkey"), name)
    for side, name in (("a", "before"), ("b", "after"))
]
_MID_DUMP = f"(SELECT * FROM daily WHERE day = DATE '{MID}')"



def _known_sql(which: str, key: str) -> str:
    return f"""WITH known AS (SELECT {key}, ts, max(event_id) AS last_id, max_by(value, event_id) AS last_value
            FROM events WHERE {which} GROUP BY {key}, ts)
        SELECT e.event_id, e.{key}, e.ts, k.last_id, k.last_value, k.last_id IS NOT NULL AS found
        FROM events e ASOF LEFT JOIN known k ON e.{key} = k.{key} AND e.ts >= k.ts"""


def _frequent_sql(items: list[str], per: int) -> str:
    listed = ", ".join(items)
    return f"""WITH {DAILY_LOG}, kept AS ({LOG_ROWS})
        SELECT {listed}, count(*) AS n, (SELECT count(*) FROM kept) AS total FROM kept
        GROUP BY {listed} HAVING count(*) * {per} >= (SELECT count(*) FROM kept)"""


ORACLE = {
    "clean_keys": """SELECT page_id, url FROM pages
        WHERE url IS NOT NULL AND NOT contains(url, '@') AND length(url) < 50""",
    "clean_rows": """SELECT source, lang, min(doc_id) AS doc_id FROM documents
        WHERE source IS NOT NULL AND NOT contains(source, '@') AND length(source) < 50
          AND lang IS NOT NULL AND NOT contains(lang, '@') AND length(lang) < 50
        GROUP BY source, lang""",
    "rejected_keys": """SELECT * FROM (
        SELECT CASE WHEN text IS NULL THEN 'text_missing'
                    WHEN contains(text, '@') THEN 'text_shifted'
                    WHEN length(text) >= 50 THEN 'text_too_long' END AS rule,
               count(*) AS rejected FROM documents GROUP BY 1) WHERE rule IS NOT NULL""",
    "dedupe_by_key": """SELECT event_id, ts, user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
    "csv_dump": "SELECT * FROM customer",
    "row_hash": """SELECT doc_id, sha256(concat_ws('||', CAST(doc_id AS VARCHAR), text, lang, source,
        CAST(n_chars AS VARCHAR))) AS hash FROM documents""",
    "row_hash_named": """SELECT c_custkey, sha256('{' || concat_ws(',',
        '"c_custkey":' || c_custkey, '"c_name":"' || c_name || '"',
        '"c_nationkey":' || c_nationkey, '"c_mktsegment":"' || c_mktsegment || '"') || '}') AS hash
        FROM customer""",
    "diff_added": f"""WITH {PAIRED} SELECT * FROM b WHERE NOT EXISTS (
        SELECT 1 FROM a WHERE a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)""",
    "diff_removed": f"""WITH {PAIRED} SELECT * FROM a WHERE NOT EXISTS (
        SELECT 1 FROM b WHERE a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)""",
    "diff_modified": f"""WITH {PAIRED} SELECT l_partkey, l_suppkey,
        a.l_linenumber AS old_number, b.l_linenumber AS new_number,
        a.l_linestatus AS old_status, b.l_linestatus AS new_status
        FROM a JOIN b USING (l_partkey, l_suppkey)
        WHERE a.l_linenumber IS DISTINCT FROM b.l_linenumber
           OR a.l_linestatus IS DISTINCT FROM b.l_linestatus""",
    "diff_classified": f"WITH {CLASSIFIED} SELECT * FROM changes WHERE change IS NOT NULL",
    "diff_summary": f"""WITH {CLASSIFIED} SELECT count(*) FILTER (change = 'added') AS inserts,
        count(*) FILTER (change = 'modified') AS updates,
        count(*) FILTER (change = 'removed') AS deletes, count(change) AS total FROM changes""",
    "diff_sample": f"""WITH {PAIRED} SELECT * FROM a WHERE NOT EXISTS (
        SELECT 1 FROM b WHERE a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)
        ORDER BY l_partkey, l_suppkey LIMIT 10""",
    "diff_repeated_keys": """WITH
        a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
              WHERE l_returnflag = 'R'),
        b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
              WHERE l_returnflag <> 'R'),
        surplus AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(s) AS n
                    FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b)
                    GROUP BY ALL HAVING sum(s) <> 0),
        ups AS (SELECT * FROM surplus WHERE n > 0), downs AS (SELECT * FROM surplus WHERE n < 0),
        per_key AS (SELECT l_orderkey, l_linenumber,
                           sum(CASE WHEN n > 0 THEN n ELSE 0 END) AS o,
                           sum(CASE WHEN n < 0 THEN -n ELSE 0 END) AS w
                    FROM surplus GROUP BY ALL),
        one_each AS (SELECT l_orderkey, l_linenumber, o, w FROM per_key WHERE o <= 1 AND w <= 1),
        several AS (SELECT l_orderkey, l_linenumber FROM per_key WHERE o > 1 OR w > 1)
        SELECT k.l_orderkey, k.l_linenumber,
               CASE WHEN o = 0 THEN 'added' WHEN w = 0 THEN 'removed' ELSE 'modified' END AS change,
               u.l_partkey AS old_l_partkey, u.l_suppkey AS old_l_suppkey,
               d.l_partkey AS new_l_partkey, d.l_suppkey AS new_l_suppkey
        FROM one_each k
        LEFT JOIN ups u ON k.l_orderkey = u.l_orderkey AND k.l_linenumber = u.l_linenumber
        LEFT JOIN downs d ON k.l_orderkey = d.l_orderkey AND k.l_linenumber = d.l_linenumber
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'removed', l_partkey, l_suppkey, NULL, NULL
        FROM (SELECT *, unnest(range(n::BIGINT)) FROM ups SEMI JOIN several USING (l_orderkey, l_linenumber))
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'added', NULL, NULL, l_partkey, l_suppkey
        FROM (SELECT *, unnest(range(-n::BIGINT)) FROM downs SEMI JOIN several USING (l_orderkey, l_linenumber))""",
    "reverse_log": f"WITH {DAILY_LOG} {LOG_ROWS}",
    "reverse_log_counts": f"WITH {DAILY_LOG} {SUMMARIES}",
    "reverse_log_yearly": f"WITH {YEARLY_LOG} {LOG_ROWS}",
    "as_of_mid": f"WITH {DAILY} SELECT * EXCLUDE (day) FROM daily WHERE day = DATE '{MID}'",
    "as_of_latest": f"""WITH {DAILY} SELECT * EXCLUDE (day) FROM daily
        WHERE day = (SELECT max(day) FROM last_event WHERE day <= DATE '{LATEST}')""",
    "as_of_before_first": f"""WITH {DAILY} SELECT * EXCLUDE (day) FROM daily
        WHERE day <= DATE '{BEFORE}'""",
    "as_of_many": f"WITH {DAILY} {MANY_DAYS}",
    "report_metrics": REPORT.format(c="o_custkey", s="o_orderpriority", t="orders"),
    "snapshot_metrics": _metrics_sql("orders", "o_orderkey", "o_custkey", "o_orderpriority"),
    "compare_metrics": f"""WITH {PAIRED} SELECT metric, before, after
        FROM {_PAIR_METRICS[0]} JOIN {_PAIR_METRICS[1]} USING (metric)""",
    "approximate_metrics": """SELECT unnest(['addresses', 'communes', 'streets', 'departments'])
        AS metric, true AS close""",
    "reconcile_extra": f"""WITH {PAIRED} SELECT l_partkey, l_suppkey FROM a
        EXCEPT SELECT l_partkey, l_suppkey FROM b""",
    "reconcile_missing": f"""WITH {PAIRED} SELECT l_partkey, l_suppkey FROM b
        EXCEPT SELECT l_partkey, l_suppkey FROM a""",
    "reconcile_rebuilt": f"""WITH {DAILY} SELECT metric, truth AS rebuilt, truth, true AS agrees
        FROM {_unpivot(_metrics_sql(_MID_DUMP, "user_id", "event_type", "value"), "truth")}""",
    "rows_per_prefix": """SELECT substring(CAST(o_custkey AS VARCHAR), 1, 2) AS prefix,
        count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY 1""",
    "ingest_log": f"WITH {YEARLY_LOG} {LOG_ROWS}",
    "ingest_summaries": f"WITH {YEARLY_LOG} {SUMMARIES}",
    "store_as_of": f"""WITH {YEARLY} SELECT * EXCLUDE (day) FROM yearly
        WHERE day = (SELECT max(day) FROM yearly WHERE day <= DATE '1998-06-30')""",
    "store_report": f"WITH {YEARLY} "
    + REPORT.format(
        c="o_orderpriority",
        s="o_totalprice",
        t="(SELECT * FROM yearly WHERE day = (SELECT max(day) FROM yearly))",
    ),
    "backfill_log": f"WITH {DAILY_LOG} {LOG_ROWS}",
    "backfill_as_of_many": f"WITH {DAILY} {MANY_DAYS}",
    "clean_null_keys": """SELECT source, lang, min(doc_id) AS doc_id FROM documents
        WHERE doc_id % 3 <> 0 AND NOT contains(source, '@') AND length(source) < 50
          AND lang IS NOT NULL AND NOT contains(lang, '@') AND length(lang) < 50
        GROUP BY source, lang""",
    "diff_null_values": f"""WITH {_CUSTOMERS} SELECT * FROM customer_changes
        WHERE change IS NOT NULL AND c_custkey IS NOT NULL""",
    "diff_null_keys": f"WITH {_CUSTOMERS} SELECT * FROM customer_changes WHERE change IS NOT NULL",
    "diff_hot_key": """WITH
        surplus AS (SELECT event_type, user_id, value, sum(s) AS n FROM (
            SELECT event_type, user_id, value, 1 AS s FROM events WHERE user_id % 3 <> 0 UNION ALL
            SELECT event_type, user_id, value, -1 FROM events WHERE user_id % 5 <> 0)
            GROUP BY ALL HAVING sum(s) <> 0),
        per_key AS (SELECT event_type, sum(greatest(n, 0)) AS o, sum(greatest(-n, 0)) AS w FROM surplus GROUP BY ALL)
        SELECT CAST(sum(CASE WHEN o = 1 AND w = 1 THEN 0 ELSE w END) AS BIGINT) AS inserts,
               CAST(sum(CASE WHEN o = 1 AND w = 1 THEN 1 ELSE 0 END) AS BIGINT) AS updates,
               CAST(sum(CASE WHEN o = 1 AND w = 1 THEN 0 ELSE o END) AS BIGINT) AS deletes,
               CAST(sum(CASE WHEN o = 1 AND w = 1 THEN 1 ELSE o + w END) AS BIGINT) AS total FROM per_key""",
    "report_null_codes": REPORT.format(
        c="nation",
        s="segment",
        t="(SELECT nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)",
    ),
    "row_hash_nulls": """SELECT c_custkey, sha256(concat_ws('||', c_name,
        CAST(nullif(c_nationkey, 3) AS VARCHAR), CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END)) AS hash
        FROM customer""",
    "csv_malformed": "SELECT c_custkey, c_custkey % 10 = 0 AS malformed FROM customer",
    "ingest_rejections": """WITH ruled AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'code_missing'
            WHEN c_custkey % 11 = 0 THEN 'code_shifted' WHEN c_custkey % 13 = 0 THEN 'code_too_long'
            WHEN c_custkey % 7 = 0 THEN 'duplicate' END AS rule FROM customer)
        SELECT rule, count(*) - CASE rule WHEN 'duplicate' THEN 1 ELSE 0 END AS refused
        FROM ruled WHERE rule IS NOT NULL GROUP BY rule""",
    "redo_day": f"""WITH {YEARLY},
        redone AS (SELECT * FROM yearly WHERE day < (SELECT max(day) FROM yearly) OR o_custkey % 3 <> 0),
        {_log_sql("redone", "redone", "o_custkey", ["o_orderstatus", "o_totalprice", "o_orderpriority"])} {LOG_ROWS}""",
    "rebuild_verified": f"""WITH {YEARLY} SELECT metric, truth AS rebuilt, truth, true AS agrees
        FROM {_unpivot(_metrics_sql("(SELECT * FROM yearly WHERE day = DATE '1996-12-31')", "o_custkey", "o_orderstatus", "o_orderpriority"), "truth")}""",
    "diff_folders": f"""WITH {PAIRED} SELECT l_partkey, l_suppkey,
        a.l_linenumber AS old_number, b.l_linenumber AS new_number,
        a.l_linestatus AS old_status, b.l_linestatus AS new_status
        FROM a JOIN b USING (l_partkey, l_suppkey)
        WHERE a.l_linenumber IS DISTINCT FROM b.l_linenumber
           OR a.l_linestatus IS DISTINCT FROM b.l_linestatus""",
    "compacted_as_of": f"""WITH {DAILY} SELECT * EXCLUDE (day) FROM daily
        WHERE day = (SELECT min(CAST(ts AS DATE)) FROM events)""",
    "compacted_as_of_mid": f"WITH {DAILY} SELECT * EXCLUDE (day) FROM daily WHERE day = DATE '{MID}'",
    "diff_stored_days": """WITH
        ranked AS (SELECT o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
                          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
                          row_number() OVER (PARTITION BY o_custkey, o_orderdate < (SELECT max(o_orderdate) FROM orders)
                                             ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn_before FROM orders),
        a AS (SELECT * EXCLUDE (rn, rn_before, o_orderdate) FROM ranked
              WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) AND rn_before = 1),
        b AS (SELECT * EXCLUDE (rn, rn_before, o_orderdate) FROM ranked WHERE rn = 1)
        SELECT b.o_custkey, CASE WHEN a.o_custkey IS NULL THEN 'added' ELSE 'modified' END AS change,
               a.o_orderstatus AS old_o_orderstatus, b.o_orderstatus AS new_o_orderstatus,
               a.o_totalprice AS old_o_totalprice, b.o_totalprice AS new_o_totalprice,
               a.o_orderpriority AS old_o_orderpriority, b.o_orderpriority AS new_o_orderpriority
        FROM b LEFT JOIN a USING (o_custkey)
        WHERE a.o_custkey IS NULL OR (a.o_orderstatus, a.o_totalprice, a.o_orderpriority)
            IS DISTINCT FROM (b.o_orderstatus, b.o_totalprice, b.o_orderpriority)""",
    "point_in_time_state": f"""WITH {DAILY} SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS on_day,
        d.event_type, d.value, d.user_id IS NOT NULL AS found
        FROM events e LEFT JOIN daily d ON d.user_id = e.user_id AND d.day = CAST(e.ts AS DATE)""",
    "point_in_time_last": _known_sql("event_type = 'purchase'", "user_id"),
    "point_in_time_hot": _known_sql("value > 100", "event_type"),
    "reconcile_by_sketch": """WITH
        a AS (SELECT o_orderkey FROM orders WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 10 DAYS),
        b AS (SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT min(o_orderdate) FROM orders) + INTERVAL 10 DAYS)
        SELECT *, 'extra' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL
        SELECT *, 'missing' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "reconcile_by_key": f"""WITH {PAIRED}
        SELECT *, 'extra' AS side FROM (SELECT l_partkey, l_suppkey FROM a EXCEPT SELECT l_partkey, l_suppkey FROM b)
        UNION ALL
        SELECT *, 'missing' AS side FROM (SELECT l_partkey, l_suppkey FROM b EXCEPT SELECT l_partkey, l_suppkey FROM a)""",
    "range_report": f"""WITH {YEARLY} SELECT metric, exact, true AS close FROM {_unpivot(
        _metrics_sql("(SELECT * FROM yearly WHERE day BETWEEN DATE '1996-12-31' AND DATE '1998-12-31')",
                     "o_custkey", "o_orderpriority", "o_totalprice"), "exact")}""",
    "arriving_dumps": f"WITH {YEARLY_LOG} {LOG_ROWS}",
    "rebuild_differences": f"""WITH {YEARLY}, y AS (SELECT o_custkey AS k FROM yearly WHERE day = DATE '1996-12-31')
        SELECT kind, CASE kind WHEN 'missing' THEN -k WHEN 'removed' THEN -k ELSE k END AS o_custkey FROM (
            SELECT unnest(['extra', 'added']) AS kind, k FROM y WHERE k % 7 = 0 UNION ALL
            SELECT unnest(['missing', 'removed']), k FROM y WHERE k % 11 = 0 AND k > 0 UNION ALL
            SELECT 'modified', k FROM y WHERE k % 7 <> 0 AND k % 13 = 0)""",
    "diff_folders_rest": f"""WITH {CLASSIFIED}, counted AS (
            SELECT count(*) FILTER (change = 'added') AS inserts, count(*) FILTER (change = 'modified') AS updates,
                   count(*) FILTER (change = 'removed') AS deletes, count(change) AS total FROM changes)
        SELECT what, CAST(n AS VARCHAR) AS value FROM (UNPIVOT counted ON inserts, updates, deletes, total INTO NAME what VALUE n)
        UNION ALL SELECT unnest(['only_before', 'l_linenumber']), unnest(['string', 'int/decimal(12,0)'])
        UNION ALL SELECT change, concat_ws('/', l_partkey, l_suppkey,
            CASE change WHEN 'added' THEN new_l_linestatus ELSE old_l_linestatus END)
        FROM changes WHERE change IN ('added', 'removed')""",
    "thin_as_of": f"WITH {DAILY} SELECT * EXCLUDE (day) FROM daily WHERE day = DATE '{MID}'",
    "thin_log_restored": f"WITH {DAILY_LOG} {LOG_ROWS}",
    "changes_per_column": f"""WITH {YEARLY},
        days AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM yearly)),
        counted AS (
            SELECT d.day, count(*) FILTER (t.o_orderstatus IS DISTINCT FROM p.o_orderstatus) AS o_orderstatus,
                   count(*) FILTER (t.o_totalprice IS DISTINCT FROM p.o_totalprice) AS o_totalprice,
                   count(*) FILTER (t.o_orderpriority IS DISTINCT FROM p.o_orderpriority) AS o_orderpriority
            FROM days d JOIN yearly p ON p.day = d.before JOIN yearly t ON t.day = d.day AND t.o_custkey = p.o_custkey
            GROUP BY d.day),
        logged AS (SELECT day, unnest(['o_orderstatus', 'o_totalprice', 'o_orderpriority']) AS "column" FROM days),
        told AS (UNPIVOT counted ON o_orderstatus, o_totalprice, o_orderpriority INTO NAME "column" VALUE changes)
        SELECT day, "column", coalesce(changes, 0) AS changes
        FROM logged LEFT JOIN told USING (day, "column")""",
    "frequent_changed_keys": _frequent_sql(["user_id"], 140),
    "frequent_changes": _frequent_sql(["action", "event_type"], 20),
}
