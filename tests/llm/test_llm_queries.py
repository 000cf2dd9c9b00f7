"""Registered text queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from homematch.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_registered():
    assert set(queries.runnable()) <= set(contract.queries()) and set(queries.checks()) <= set(contract.oracle_sql())
    assert {n.split("_")[0] for n in queries.runnable()} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(queries.checks()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.runnable()[name](spark, FOLDER)
    cursor = con.execute(queries.checks()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted((tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == expected
