"""Every query beside its SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(TABLES)):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{TABLES}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return v.isoformat() if isinstance(v, datetime.datetime) else repr(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, TABLES)
    got = table(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    want = table([c[0] for c in cur.description], cur.fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
