"""CSV dumps: `;`-separated, one header line, UTF-8."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.text import idents
from .files import exists
from .schema import ADDRESS_SCHEMA, MALFORMED, as_day, declared_columns


def read_dump(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = ADDRESS_SCHEMA,
    sep: str = ";",
    mode: str = "PERMISSIVE",
    mark: bool = False,
) -> DataFrame:
    """One dump with the declared columns, matched by the header's names.

    Only the header is read up front. Types are declared, never inferred, so
    the data is parsed once and two days always agree. Short lines are padded
    with nulls, surplus fields dropped, blank lines skipped, and blanks inside
    a value kept. A declared column the file lacks is null; a column the file
    adds is neither parsed nor returned.

    With ``mark`` a column ``_malformed`` comes last: the whole line where it
    is short, has a surplus, or holds a value its type cannot take, else null.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("sep", sep)
    header = reader.csv(paths).columns
    declared = {f.name: f.dataType for f in schema.fields}
    found = [c for c in header if c in declared]
    if not found:
        raise ValueError(f"no declared column in the header of {paths}: {header}")
    in_file_order = T.StructType(
        [T.StructField(c, declared.get(c, T.StringType())) for c in header]
    )
    if mark:
        in_file_order = in_file_order.add(MALFORMED, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    rows = (
        reader.option("mode", mode)
        # Checks the names in every file's header, not only in the first one's.
        .option("enforceSchema", False)
        .schema(in_file_order)
        .csv(paths)
    )
    if not mark:
        return rows.selectExpr(*declared_columns(schema, found))
    # Spark judges a line by the columns a query reads. The mark refers to all
    # of them, at no cost for a line that is in order.
    read = ", ".join(f"CAST({c} AS STRING)" for c in idents(header))
    marked = (
        f"CASE WHEN {MALFORMED} IS NULL THEN NULL"
        f" WHEN length(concat_ws('', {read})) >= 0 THEN {MALFORMED} END AS {MALFORMED}"
    )
    return rows.selectExpr(*declared_columns(schema, found), marked)


def dump_path(spark: SparkSession, folder: str, day: dt.date | str) -> str:
    """Path of a day's dump: a file of its own, or else a file in the day's folder."""
    base = f"{folder.rstrip('/')}/dump-{as_day(day).isoformat()}"
    for path in (f"{base}.csv", f"{base}/adresses.csv"):
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"no dump of {day} in {folder}")
