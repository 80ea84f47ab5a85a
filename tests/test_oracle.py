"""Every query with a DuckDB form gives the same rows in both engines on the smallest tables."""

import os
from numbers import Number

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def cell(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
        return "null"
    if isinstance(x, Number) and not isinstance(x, bool):
        return str(round(float(x), 6))
    return str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.oracle_sql() if n in __spark_entry__.queries() and not n.startswith(("op", "pipeline"))))
def test_same_rows(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    want = duck.sql(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_a_form():
    assert {n for n in __spark_entry__.queries() if not n.startswith(("op", "pipeline"))} == {n for n in __spark_entry__.oracle_sql() if not n.startswith(("op", "pipeline"))}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
