"""Nearest vectors by cosine against the query's SQL: copies, ties, zeros, several tiles; nulls, which its SQL refuses, by hand."""

import random

import duckdb
import pytest

from watchloom.operators import nearest as N
from watchloom.plans import registry

NAME = "Y05_cosine_top"


def some_vectors():
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(150)]
    rows = {i: list(base[rng.randrange(150)] if i % 3 else base[0]) for i in range(1200)}  # a third of them one vector
    rows |= {i: [x * 3 for x in rows[i]] for i in range(0, 1200, 7)} | {i: [-x for x in rows[i]] for i in range(5, 1200, 91)}
    rows |= {i: [0.0] * 8 for i in (3, 400, 700, 701)} | {20: [1e200] * 8, 21: [1e-200] * 8}
    return list(rows.items()) + [(None, base[1])]


@pytest.mark.parametrize("blocks", [(1024, 4096, 32 << 20), (7, 64, 512), (4, 3, 32 << 20)])
def test_the_query_equals_its_sql(spark, tmp_path, monkeypatch, blocks):
    for constant, value in zip(("QUERIES", "VECTORS", "HELD"), blocks, strict=True):
        monkeypatch.setattr(N, constant, value)
    spark.createDataFrame(some_vectors(), "vec_id long, embedding array<double>").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    embeddings = duckdb.read_parquet(f"{tmp_path}/embeddings.parquet/*.parquet")  # noqa: F841  read by the SQL
    plain = lambda rows: sorted((q, v, "nan" if c != c else c) for q, v, c in rows)
    want = plain(duckdb.sql(f"select qid, vec_id, c from ({registry.oracle_sql()[NAME]})").fetchall())
    df = registry.queries()[NAME](spark, str(tmp_path))
    assert plain(tuple(r) for r in df.select("qid", "vec_id", "c").collect()) == want and len(want) == 72
    plan = df._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fewer_vectors_than_asked_for_and_other_lengths(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0]), (4, [1.0, None]), (5, []), (6, None)], schema)
    got = [tuple(r) for r in N.nearest(few, few.where("vec_id < 4"), 3).orderBy("query_id", "rank").collect()]
    c = 1 / 2**0.5
    assert [(q, k, v, x and round(x, 9)) for q, k, v, x in got] == [(1, 1, 2, round(c, 9)), (1, 2, 3, None), (1, 3, 4, None), (2, 1, 1, round(c, 9)), (2, 2, 3, None), (2, 3, 4, None), (3, 1, 1, None), (3, 2, 2, None), (3, 3, 4, None)]
    none = few.where("vec_id > 9")
    assert N.nearest(few, none, 3).count() == 0 and N.nearest(none, few, 3).count() == 0
