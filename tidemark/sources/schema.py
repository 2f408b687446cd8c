"""Declared schemas and the check a frame must pass to enter a store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.text import ident

# The columns of a daily address dump, in file order. Codes are
# text, so that `01001` keeps its zero and `2A001` fits the same column.
ADDRESS_SCHEMA = T.StructType(
    [
        T.StructField("uid_adresse", T.StringType()),
        T.StructField("cle_interop", T.StringType()),
        T.StructField("commune_insee", T.StringType()),
        T.StructField("commune_nom", T.StringType()),
        T.StructField("commune_deleguee_insee", T.StringType()),
        T.StructField("commune_deleguee_nom", T.StringType()),
        T.StructField("voie_nom", T.StringType()),
        T.StructField("lieudit_complement_nom", T.StringType()),
        T.StructField("numero", T.IntegerType()),
        T.StructField("suffixe", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("cad_parcelles", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("date_der_maj", T.DateType()),
        T.StructField("certification_commune", T.IntegerType()),
    ]
)
ADDRESS_KEYS = ["cle_interop"]

# Names the log adds to the row.
ACTION = "action"
DAY = "day"
# Holds the text of a line that did not fit its declared types, else null.
MALFORMED = "_malformed"


def log_schema(schema: T.StructType) -> T.StructType:
    """The row, what undoing the day does to it, and the day."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField(ACTION, T.StringType()),
            T.StructField(DAY, T.DateType()),
        ]
    )


def as_day(value: dt.date | str) -> dt.date:
    """A date, from a date or from ``YYYY-MM-DD``; anything else raises."""
    if isinstance(value, dt.datetime):
        raise TypeError("a day is a date, not a date with a time")
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def conform(
    df: DataFrame, schema: T.StructType, keys: Sequence[str], extra: str = "refuse"
) -> DataFrame:
    """``df`` with exactly the declared columns, in declared order.

    A declared column the frame lacks becomes null, unless it is a key. A
    column of another type is refused: one day's `1` against the next day's
    `1.0` would mark every row as changed. Undeclared columns are refused, or
    left out with ``extra="drop"``. The mark of malformed lines stays, if there.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing_keys = [k for k in keys if k not in have]
    if missing_keys:
        raise ValueError(f"key columns missing from the dump: {missing_keys}")
    wrong = [
        f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name in have and have[f.name] != f.dataType
    ]
    if wrong:
        raise TypeError(f"columns of another type: {wrong}")
    mark = [MALFORMED] if MALFORMED in have and MALFORMED not in schema.fieldNames() else []
    undeclared = [c for c in have if c not in {*schema.fieldNames(), *mark}]
    if undeclared and extra != "drop":
        raise ValueError(f"undeclared columns: {undeclared}")
    return df.selectExpr(*declared_columns(schema, have), *mark)


def declared_columns(schema: T.StructType, have: Collection[str]) -> list[str]:
    """The declared columns in order, null where ``have`` lacks one."""
    return [
        ident(f.name)
        if f.name in have
        else f"CAST(NULL AS {f.dataType.simpleString()}) AS {ident(f.name)}"
        for f in schema.fields
    ]
