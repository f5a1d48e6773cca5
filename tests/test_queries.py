"""Every registered query against DuckDB on the given tables."""

import datetime
import decimal
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
ORACLE = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    columns, rows = table_of(result.columns, [tuple(r) for r in result.collect()])
    assert len(columns) == len({c.lower() for c in columns})
    assert rows
    if name in ORACLE:
        expected = duck.execute(ORACLE[name])
        assert (columns, rows) == table_of([c[0] for c in expected.description], expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_dimension_has_a_case_of_every_kind(spark):
    actions = {r["action"] for r in queries()["scd2_stats"](spark, "/root/testdata/sf0.01").collect()}
    assert actions == {"insert", "same", "version", "inplace", "missing"}
    assert queries()["scd2_blank"](spark, FOLDER).count() > 0
