"""Every registered query runs on the smallest tables, and equals its SQL there."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallyforge.plans import problems, registry

DATA = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", [*registry.QUERIES, *problems.QUERIES])
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(v) for v in r)) for r in df.select(*columns).collect())
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql)
        at = [want.columns.index(c) for c in columns]
        assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
