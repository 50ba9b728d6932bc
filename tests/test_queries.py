"""Every query with SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pytest

from framespool.plans import bindings

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if v is None or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.5f}" if isinstance(v, float) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted("|".join(value(r[k]) for k in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(bindings.SQL))
def test_query(spark, duck, name):
    df = bindings.QUERIES[name](spark, DIR)
    columns = [x[0] for x in duck.execute("DESCRIBE " + bindings.SQL[name]).fetchall()]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, duck.execute(bindings.SQL[name]).fetchall())


def test_every_query_has_sql():
    assert set(bindings.QUERIES) == set(bindings.SQL)
