"""Every registered query against its SQL, on the smallest data set."""

import os
from collections import Counter

import duckdb
import pytest

from checks import load

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _rows(records, order):
    return Counter(tuple(r[i] for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(load()))
def test_query_matches_sql(spark, duck, name):
    q = load()[name]
    df = q.run(spark, DATA)
    mine = [tuple(r) for r in df.collect()]
    assert mine
    if q.sql is None:
        return
    rel = duck.sql(q.sql)
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    got = _rows(mine, [df.columns.index(c) for c in order])
    want = _rows(rel.fetchall(), [rel.columns.index(c) for c in order])
    assert got == want
