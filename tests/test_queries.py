"""Every query of the engine with SQL gives DuckDB's rows on the smallest tables; the others give rows."""

import decimal
import math
from collections import Counter

import duckdb
import pytest

from watchloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    r = duck.sql(sql)
    assert sorted(r.columns) == columns
    at = [r.columns.index(c) for c in columns]
    assert got == Counter(tuple(plain(x[i]) for i in at) for x in r.fetchall())
