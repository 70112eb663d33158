"""Every registered query against its SQL twin in DuckDB, on whole tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT:
        return "null"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool) or isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return "null" if math.isnan(v) else f"{round(v, 6) + 0.0:.6f}"
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    want = rows(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert found == want
    assert want, "the twin should not be empty"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
