"""The corpus queries with SQL give the rows their SQL gives, over the whole tables of the smallest test data."""

import glob
import os

import duckdb
import pytest

from ledgerline.llm import queries, sql

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        duck.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = duck.sql(sql.SQL[name])
    order = [list(result.columns).index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
