"""Queries with a DuckDB twin give its rows on the smallest test tables, and every operator is registered."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from geotally.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_match(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    result = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    assert got == sorted((tuple(plain(r[columns.index(c)]) for c in names) for r in result.fetchall()), key=str)


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
