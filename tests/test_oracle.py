"""Every registered query equals its SQL twin on DuckDB (values, names, types) at sf0.001."""

import math
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as E
from repolens.plans.catalog import QUERIES
from repolens.plans.oracle import SQL
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _type(t):
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_type(t.value_type)}>"
    return str(t)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= E.queries().items() and SQL.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert {f.name: _type(f.type) for f in got.schema} == {f.name: _type(f.type) for f in want.schema}
    cols = sorted(got.column_names)
    g = Counter(tuple(_norm(r[c]) for c in cols) for r in got.select(cols).to_pylist())
    w = Counter(tuple(_norm(r[c]) for c in cols) for r in want.select(cols).to_pylist())
    assert g == w


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["repository", "median_days_between_feature_prs"]
    assert df.count() >= 0
