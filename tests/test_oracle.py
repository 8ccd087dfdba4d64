"""Every registered query against its DuckDB oracle at sf0.001.

Columns are matched by name, rows as an order-insensitive multiset, values
exactly (money and percentages are exact on both sides)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from shopflow.plans.queries import REGISTRY
from shopflow.sources.tables import TABLES

from .conftest import SF001


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(tuple(sorted(v.asDict().items())))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "cuota_mercado_pct" in df.columns


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) and set(REGISTRY) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    a = Counter(tuple(_norm(r[c]) for c in order) for r in got)
    b = Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in want)
    assert a == b, f"{name}: spark-only {list(a - b)[:2]} oracle-only {list(b - a)[:2]}"
