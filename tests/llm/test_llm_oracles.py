"""Queries that SQL can express equal their SQL, value for value."""

import duckdb
import pytest

from kiln.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        (tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
