"""The registered queries: names, and Spark against DuckDB where SQL can express them."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from rankloom.llm import catalog

DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, DIR)
    rel = con.sql(catalog.SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = Counter(rel.project(", ".join(f'"{c}"' for c in df.columns)).fetchall())
    assert Counter(map(tuple, df.collect())) == want
