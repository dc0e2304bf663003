"""Queries of the subpackage that have SQL give the rows of that SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from conftest import DATA

from tidemark.llm import plans


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    df = plans.QUERIES[name](spark, DATA)
    rel = con.sql(plans.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in rel.fetchall())
