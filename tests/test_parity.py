"""Every query with SQL gives the rows its SQL gives, over the whole tables of the smallest test data."""

import glob
import math
import os

import duckdb
import pytest

from ledgerline.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value if value is None or isinstance(value, (int, str, bool)) else round(float(value), 9)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.sql(catalog.SQL[name])
    order = [list(result.columns).index(c) for c in columns]
    assert len(result.columns) == len(columns)
    assert ours == sorted((tuple(plain(row[i]) for i in order) for row in result.fetchall()), key=repr)


def test_flagship_is_registered():
    assert catalog.FLAGSHIP in catalog.QUERIES and catalog.FLAGSHIP in catalog.SQL


def test_payload_facts_are_all_read(spark, tmp_path):
    good, bare = '{"kind": "principal", "currency": "USD"}', '{"kind": "fee", "currency": null}'
    rows = [(f"[{good}]",), (f"[{good}, {bare}]",), (f'[{good}, {{"currency": "USD"}}]',), (f"[{good}, 1]",), ("[]",), ("{}",), ("[",), (None,)]
    spark.createDataFrame(rows, "amounts_json string").write.parquet(f"{tmp_path}/mentions.parquet")
    found = {r.problem: r.n for r in catalog.QUERIES["payload_facts_check"](spark, str(tmp_path)).collect()}
    assert found == {"ok": 1, "no currency": 1, "no kind": 2, "empty": 1, "not a list": 1, "not json": 1, "missing": 1}
    c = duckdb.connect()
    c.execute(f"create view mentions as select * from '{tmp_path}/mentions.parquet/*.parquet'")
    assert dict(c.sql(catalog.SQL["payload_facts_check"]).fetchall()) == found
