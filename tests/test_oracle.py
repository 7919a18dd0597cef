"""Every registered query with a DuckDB form matches it on sf0.001; the
others run and return a stable schema."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from faresight.sources.tables import TABLES

OPTIONAL = set(E._LLM_QUERIES)  # tested beside their operators


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - OPTIONAL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - OPTIONAL))
def test_rows_only_query_runs(spark, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)
    assert any(v is not None for r in rows for v in r)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 8 and set(df.columns) == {"config", "r2", "mae", "coverage"}
