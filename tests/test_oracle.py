"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
QUERIES = {k: f for p in entry._CORE for k, f in p.QUERIES.items()}
ORACLE = {k: s for p in entry._CORE for k, s in p.ORACLE.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else float(f"{float(v):.9g}")
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return con


def same(spark, duck, query, sql):
    df = query(spark, D)
    cols = sorted(df.columns)
    mine = Counter(str([plain(r[c]) for c in cols]) for r in df.collect())
    cur = duck.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    theirs = Counter(str([plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    same(spark, duck, QUERIES[name], ORACLE[name])


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
