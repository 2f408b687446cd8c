"""Every registered query against its SQL in DuckDB, on whole tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import workload

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got, expected = _bag(df.columns, df.collect()), _bag(columns, cursor.fetchall())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected
    if name not in {"as_of_before_first"}:
        assert got


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLE)
    assert set(workload.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    ("name", "condition"),
    [
        ("diff_null_values", "old_c_acctbal IS NULL AND new_c_acctbal IS NOT NULL AND change = 'modified'"),
        ("diff_null_keys", "c_custkey IS NULL"),
        ("csv_malformed", "malformed"),
    ],
)
def test_nulls_are_met(spark, name, condition):
    assert not workload.QUERIES[name](spark, SF).filter(condition).isEmpty()
