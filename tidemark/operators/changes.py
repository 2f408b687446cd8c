"""Changes between two snapshots of one table.

``compare`` classifies every key with one full outer join; all other functions
here project, count or invert its result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import differs, ident, idents
from ..functions.unions import union_all
from ..sources.schema import ACTION, DAY

ADDED, REMOVED, MODIFIED = "added", "removed", "modified"

# What undoing a change does to the table.
UNDO = {ADDED: "DELETE", REMOVED: "INSERT", MODIFIED: "UPDATE"}


def compare(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    ignore: Sequence[str] = ("hash",),
    unique_keys: bool = False,
) -> DataFrame:
    """Every row that was added, removed or modified.

    Columns: the keys, ``change``, then ``old_<c>`` and ``new_<c>`` for each
    non-key column the two sides share (``ignore`` left out). Values compare
    null-safe. Null keys equal nothing, so such rows are always added or
    removed.

    ``unique_keys=True`` promises that each side holds a key at most once and
    no null keys, as every snapshot of a store does. Each side is then
    shuffled once on the keys, or not at all when both are bucketed alike.

    Without the promise the sides are compared as multisets of rows. What is
    equal cancels out first, in one aggregation over whole rows that no hot
    key can skew. A key left with one old and one new row was modified; for
    any other number of them there is no telling which became which, and
    pairing all would be quadratic, so its rows come out as removed and added.
    """
    columns = [c for c in before.columns if c in after.columns and c not in {*keys, *ignore}]
    clash = {f"{p}_{c}" for c in columns for p in ("old", "new")} & {*keys, "change"}
    if clash:
        raise ValueError(f"key names that clash with result columns: {sorted(clash)}")
    a = before.select(*idents([*keys, *columns]))
    b = after.select(*idents([*keys, *columns]))
    if unique_keys:
        return _classify(a, b, keys, columns)

    some_null = " OR ".join(f"{k} IS NULL" for k in idents(keys))
    parts = [
        _one_sided(a.filter(some_null), keys, columns, REMOVED),
        _one_sided(b.filter(some_null), keys, columns, ADDED),
        _multiset_changes(
            a.filter(f"NOT ({some_null})"), b.filter(f"NOT ({some_null})"), keys, columns
        ),
    ]
    return union_all(parts)


def _classify(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    a = before.selectExpr("*", "true AS __here").alias("__a")
    b = after.selectExpr("*", "true AS __here").alias("__b")
    on = " AND ".join(f"{ident(k, '__a')} = {ident(k, '__b')}" for k in keys)
    change = (
        f"CASE WHEN __a.__here IS NULL THEN '{ADDED}' WHEN __b.__here IS NULL THEN '{REMOVED}'"
        f" WHEN {differs(columns, '__a', '__b')} THEN '{MODIFIED}' END"
    )
    joined = a.join(b, F.expr(on), "full_outer")
    return joined.selectExpr(
        *[f"coalesce({ident(k, '__a')}, {ident(k, '__b')}) AS {ident(k)}" for k in keys],
        f"{change} AS change",
        *_images(columns),
    ).filter("change IS NOT NULL")


def _one_sided(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], change: str
) -> DataFrame:
    present = "old" if change == REMOVED else "new"
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def value(prefix: str, c: str) -> str:
        return ident(c) if prefix == present else f"CAST(NULL AS {types[c]})"

    return rows.selectExpr(
        *idents(keys),
        f"'{change}' AS change",
        *[
            f"{value(prefix, c)} AS {ident(f'{prefix}_{c}')}"
            for prefix in ("old", "new")
            for c in columns
        ],
    )


def _multiset_changes(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    salts: int = 32,
) -> DataFrame:
    signed = union_all([before.selectExpr("*", "1 AS __n"), after.selectExpr("*", "-1 AS __n")])
    # Copies more on the old side, or fewer.
    surplus = (
        signed.groupBy(*idents([*keys, *columns]))
        .agg(F.sum("__n").alias("__n"))
        .filter("__n <> 0")
    )
    row = f"struct({', '.join(idents(columns) or ['1 AS __none'])})"
    per_key = surplus.groupBy(*idents(keys)).agg(
        F.expr("count_if(__n > 0) <= 1 AND count_if(__n < 0) <= 1 AS __few"),
        F.expr("sum(greatest(__n, 0)) AS __ups"),
        F.expr("sum(greatest(-__n, 0)) AS __downs"),
        F.expr(f"any_value({row}) FILTER (WHERE __n > 0) AS __a"),
        F.expr(f"any_value({row}) FILTER (WHERE __n < 0) AS __b"),
    )
    # A key with one row a side at most has its rows at hand.
    pair = "__ups = 1 AND __downs = 1"
    modified = per_key.filter(f"__few AND {pair}").selectExpr(
        *idents(keys),
        f"'{MODIFIED}' AS change",
        *[f"{ident(c, side)} AS {ident(f'{prefix}_{c}')}" for prefix, side in (("old", "__a"), ("new", "__b")) for c in columns],
    )
    sides = "inline(array(struct(__ups AS __n, __a AS __row), struct(-__downs AS __n, __b AS __row)))"
    unpaired = (
        per_key.filter(f"__few AND NOT ({pair})")
        .selectExpr(*idents(keys), sides)
        .filter("__n <> 0")
        .selectExpr(*idents(keys), *[f"{ident(c, '__row')} AS {ident(c)}" for c in columns], "__n")
    )
    # The rows of any other key meet the key in `salts` places, so that a key
    # with very many of them is no task's alone.
    several = per_key.filter("NOT __few").selectExpr(
        *idents(keys), f"explode(sequence(0, {salts - 1})) AS __salt"
    )
    salt = f"CAST(pmod(xxhash64({', '.join(idents([*keys, *columns]))}), {salts}) AS INT) AS __salt"
    crowded = (
        surplus.selectExpr("*", salt)
        .join(several, [*keys, "__salt"], "left_semi")
        .selectExpr(*idents([*keys, *columns]), "__n")
    )
    change = f"if(__n > 0, '{REMOVED}', '{ADDED}')"
    single = _repeat(union_all([unpaired, crowded]), [*keys, *columns]).selectExpr(
        *idents(keys),
        f"{change} AS change",
        *[f"if(__n > 0, {ident(c)}, NULL) AS {ident(f'old_{c}')}" for c in columns],
        *[f"if(__n < 0, {ident(c)}, NULL) AS {ident(f'new_{c}')}" for c in columns],
    )
    return union_all([modified, single])


def _repeat(rows: DataFrame, columns: Sequence[str], chunk: int = 10_000) -> DataFrame:
    """Each row as often as ``__n`` says.

    The copies of a row that has more than ``chunk`` are spread over tasks;
    all others are repeated where they are.
    """
    copies = "explode(sequence(1L, abs(__n))) AS __copy"
    few = rows.filter(f"abs(__n) <= {chunk}").selectExpr("*", copies)
    chunked = (
        rows.filter(f"abs(__n) > {chunk}")
        .selectExpr("*", f"explode(sequence(0L, (abs(__n) - 1) DIV {chunk})) AS __chunk")
        .repartition(*idents(columns), "__chunk")
    )
    left = f"least({chunk}L, abs(__n) - __chunk * {chunk})"
    many = chunked.selectExpr("*", f"explode(sequence(1L, {left})) AS __copy").drop("__chunk")
    return union_all([few, many])


def _images(columns: Sequence[str]) -> list[str]:
    return [
        f"{ident(c, side)} AS {ident(f'{prefix}_{c}')}"
        for prefix, side in (("old", "__a"), ("new", "__b"))
        for c in columns
    ]


def removed_rows(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows only the first side has."""
    return _image(changes, keys, columns, REMOVED, "old")


def added_rows(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows only the second side has."""
    return _image(changes, keys, columns, ADDED, "new")


def _image(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str] | None, change: str, prefix: str
) -> DataFrame:
    if columns is None:
        columns = [c[4:] for c in changes.columns if c.startswith(f"{prefix}_") and c not in keys]
    return changes.filter(f"change = '{change}'").selectExpr(
        *idents(keys),
        *[f"{ident(f'{prefix}_{c}')} AS {ident(c)}" for c in columns],
    )


def modified_rows(
    changes: DataFrame, keys: Sequence[str], columns: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Old and new values side by side, for keys both sides have.

    ``columns`` maps a short name to a column: ``{"commune": "commune_nom"}``
    gives ``old_commune`` and ``new_commune``. A list keeps the names.
    """
    short = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return changes.filter(f"change = '{MODIFIED}'").selectExpr(
        *idents(keys),
        *[
            f"{ident(f'{side}_{column}')} AS {ident(f'{side}_{name}')}"
            for name, column in short.items()
            for side in ("old", "new")
        ],
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """One row: inserts, updates, deletes and their total."""
    return _counts(changes, "change", (ADDED, MODIFIED, REMOVED))


def change_sample(rows: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by key, then by all other columns."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.orderBy(*idents([*keys, *rest])).limit(n)


def column_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns only one side has, or whose types differ.

    Columns: ``column``, ``before_type``, ``after_type``; null where absent.
    """
    a = {f.name: f.dataType.simpleString() for f in before.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in after.schema.fields}
    rows = [(c, a.get(c), b.get(c)) for c in sorted({*a, *b}) if a.get(c) != b.get(c)]
    return before.sparkSession.createDataFrame(
        rows, "column string, before_type string, after_type string"
    )


def reverse_delta(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns ``after`` back into ``before``; both hold a key at most once.

    Columns of ``after``, then ``action``: DELETE with the new row, INSERT or
    UPDATE with the old one.
    """
    changes = compare(before, after, keys, ignore=(), unique_keys=True)
    is_new = f"change = '{ADDED}'"
    undo = " ".join(f"WHEN '{change}' THEN '{action}'" for change, action in UNDO.items())
    return changes.selectExpr(
        *[
            ident(c)
            if c in keys
            else f"if({is_new}, {ident(f'new_{c}')}, {ident(f'old_{c}')}) AS {ident(c)}"
            for c in after.columns
        ],
        f"CASE change {undo} END AS {ACTION}",
    )


def log_summary(log: DataFrame, per_day: bool = True) -> DataFrame:
    """Changes in a reverse log, per day or in one row; DELETE undoes an insert."""
    actions = (UNDO[ADDED], UNDO[MODIFIED], UNDO[REMOVED])
    return _counts(log, ACTION, actions, [DAY] if per_day else [])


def _counts(
    rows: DataFrame, column: str, values: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    names = ("inserts", "updates", "deletes")
    return rows.groupBy(*by).agg(
        *[F.expr(f"count_if({column} = '{v}') AS {n}") for n, v in zip(names, values)],
        F.count("*").alias("total"),
    )
