"""Every core query that has SQL gives the rows of that SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from conftest import DATA

from tidemark.plans import registry

SQL = registry.oracle_sql()


def norm(x):
    if isinstance(x, float):
        return "nan" if x != x else repr(round(x, 6) + 0.0)
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(norm, x)) + "]"
    return str(x)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, DATA)
    rel = con.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    mine = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    assert mine == Counter(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_every_query_is_registered_once():
    assert set(SQL) <= set(registry.queries())
