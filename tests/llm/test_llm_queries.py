"""The operators' queries against their SQL in DuckDB."""

import os

import duckdb
import pytest

from feedkit.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    got = QUERIES[name](spark, FOLDER)
    with duckdb.connect() as db:
        for table in ("documents", "labels", "pages", "conversations"):
            db.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
        answer = db.execute(ORACLE[name])
        columns = [c[0] for c in answer.description]
        want = answer.fetchall()
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, len(QUERIES) + 1))
