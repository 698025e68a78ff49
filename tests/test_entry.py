"""Driver contract: entry() runs; every SQL oracle agrees with its query."""

import math
import sys

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from kiln.plans.catalog import QUERIES
from kiln.plans.oracles import ORACLES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
NO_ORACLE = {"als_rank_search", "als_test_rmse", "als_personal_rmse", "recommend_for_user"}


def norm(v):
    """Exact values (no rounding): the queries round where summation order
    could matter, in both engines."""
    if isinstance(v, float) and math.isinf(v):
        return "inf"
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["status", "count"]


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


def test_further_queries_come_only_with_their_package(monkeypatch):
    monkeypatch.setitem(sys.modules, "kiln.llm", None)
    assert entry_mod.queries() == QUERIES and entry_mod.oracle_sql() == ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    srows = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    res = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    drows = sorted((tuple(norm(r[i]) for i in order) for r in res.fetchall()), key=repr)
    assert srows == drows
