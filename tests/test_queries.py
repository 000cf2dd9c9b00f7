"""Registered queries against their SQL on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from homematch.plans.views import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = round(float(value), 4)
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_against_sql(spark, database, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = database.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
