"""Every query gives the rows of its SQL. On the smallest test data."""

import datetime as dt
import glob
import math
import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__
from rateloom.queries import deliveries, pipelines, problems, relational

QUERIES = {**problems.QUERIES, **relational.QUERIES, **pipelines.QUERIES, **deliveries.QUERIES}
ORACLES = {**problems.ORACLES, **relational.ORACLES, **pipelines.ORACLES, **deliveries.ORACLES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, dt.datetime) else repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_contract(spark):
    assert __spark_entry__.entry(spark).columns == ["source_sha256", "record_no", "reason"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert {f"p{n}_found" for n in range(1, 8)} <= set(__spark_entry__.queries())
