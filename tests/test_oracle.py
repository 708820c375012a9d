"""Every registered query against its DuckDB twin on the driver's tables (as the driver's correctness check)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from geotally.plans import catalog
from helpers import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def canon(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if v is None:
            return (0, "")
        if isinstance(v, float):
            return (1, "nan") if math.isnan(v) else (1, repr(v))
        return (1, str(v))
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql_or_is_declared_non_sql():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"sample"}
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["place_name", "place_n", "r", "word", "n"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = catalog.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(catalog.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(got, df.columns) == canon(res.fetchall(), ocols)
