"""ALS from shards: the model is Spark's, and no task holds a fixed part of all ratings."""

import math
import os

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from kiln.operators import recommend as rc
from kiln.operators import shards as sh
from kiln.sources.readers import RATING_SCHEMA


def _ratings(spark):
    """Negative and far ids, a user with every item, an item with every user, a pair twice."""
    items = [-7, 0, 1, 5, 2**31 - 1, -2**31, *range(10, 30)]
    rows = [(u, m, float((3 * u + m) % 5) + 0.3) for u in range(-4, 36) for k, m in enumerate(items)
            if (u + k) % 3 == 0 or u == 2 or m == 5]
    rows += [(2, 5, 4.0), (2, 5, 1.0)]
    return rows, spark.createDataFrame(rows, RATING_SCHEMA).repartition(3)


@pytest.fixture
def sharded(monkeypatch):
    """From now on every fit is one from shards, of about ``n`` ratings."""
    def on(n):
        monkeypatch.setattr(rc, "SPARK_RATINGS", 0)
        monkeypatch.setattr(sh, "SHARD_RATINGS", n)
    return on


def _factors(frame):
    return {r["id"]: r["features"] for r in frame.collect()}


@pytest.mark.parametrize("kw", [{}, {"seed": 5, "blocks": 3, "reg": 0.5, "max_iter": 2}])
def test_model_is_that_of_spark(spark, sharded, kw):
    rows, train = _ratings(spark)
    want = rc.fit(train, 3, **kw)
    sharded(len(rows) // 3)
    got = rc.fit(train, 3, **kw)
    assert got.rank == 3 and got.getColdStartStrategy() == "drop"
    for side in ("userFactors", "itemFactors"):
        a, b = _factors(getattr(want, side)), _factors(getattr(got, side))
        assert a.keys() == b.keys()
        assert all(np.allclose(a[k], b[k], rtol=1e-4, atol=1e-5) for k in a)


def test_spark_fits_no_more_than_one_rating_of_a_user(spark, sharded, monkeypatch):
    """What Spark's blocks hold follows the users and not the ratings, and a shard its share."""
    rows, train = _ratings(spark)
    want, _, _ = rc.rank_search(train, train, ranks=(2, 3), max_iter=2)
    fits, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data, *a: fits.append(data.count()) or fit(self, data, *a))
    sharded(len(rows) // 3)
    got, _, _ = rc.rank_search(train, train, ranks=(2, 3), max_iter=2)
    assert fits == [40, 40]
    for a, b in zip(want.collect(), got.collect()):
        assert (a["rank"], a["is_best"]) == (b["rank"], b["is_best"]) and math.isclose(a["rmse"], b["rmse"], rel_tol=1e-5)


def test_every_rating_is_dealt_once_to_each_side(spark, sharded):
    rows, train = _ratings(spark)
    sharded(len(rows) // 4 + 1)
    dealt = sh.deal(train, rc.make_als(), len(rows))
    assert dealt.shards == 4
    for frame in (dealt.by_user, dealt.by_item):
        sizes = [len(r["rating"]) // 4 for r in frame.where("rating IS NOT NULL").collect()]
        assert sum(sizes) == len(rows) and len(sizes) > 1


def test_windows_and_pieces_change_no_solution():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 40, 2, 7, 1, 23, 5])
    starts = (np.cumsum(lengths) - lengths).astype(np.int32)
    n, factors = lengths.sum(), rng.normal(size=(50, 3)).astype(np.float32)
    source, rating = rng.integers(0, 50, n).astype(np.int32), rng.random(n).astype(np.float32)
    want = []
    for a, k in zip(starts, lengths):
        y = factors[source[a:a + k]].astype(float)
        want.append(np.linalg.solve(y.T @ y + 0.1 * k * np.eye(3), y.T @ rating[a:a + k]))
    for window in (1, 5, 8, 41, 1000):
        for piece in (1, 4, 64):
            got = sh.normal_solutions(starts, source, rating, factors, 0.1, window, piece)
            assert np.allclose(got, want, rtol=1e-5, atol=1e-6), (window, piece)


@pytest.mark.parametrize("bad", [(None, 2, 1.0), (1, None, 1.0), (1, 3, None), (1, 3, math.nan)])
def test_missing_ids_and_ratings_fail_as_in_spark(spark, sharded, bad):
    train = spark.createDataFrame([(1, 2, 3.0), (4, 2, 3.0), bad], RATING_SCHEMA)
    with pytest.raises(Exception, match="MUST NOT be"):
        rc.fit(train, 2)
    sharded(10)
    with pytest.raises(Exception, match="neither null nor NaN"):
        rc.fit(train, 2)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("als"))
    li = [(i % 160, (i * 7 + i // 40) % 45, 1, float(i % 47 + 1)) for i in range(1800)]
    for name, rows, schema in (
            ("lineitem", li, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double"),
            ("orders", [(o, (o * 11) % 31) for o in range(160)], "o_orderkey long, o_custkey long"),
            ("part", [(p, f"part {p}") for p in range(45)], "p_partkey long, p_name string")):
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


@pytest.mark.parametrize("name", ["als_rank_search_verified", "als_rank_search", "als_personal_rmse",
                                  "recommend_for_user", "als_test_rmse"])
def test_queries_return_the_same_from_shards(spark, sharded, tables, monkeypatch, name):
    from kiln.plans.catalog import QUERIES
    want = QUERIES[name](spark, tables).collect()
    sizes, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data, *a: sizes.append(data.count()) or fit(self, data, *a))
    sharded(400)
    got = QUERIES[name](spark, tables).collect()
    assert sizes and max(sizes) <= 32
    assert len(want) == len(got) > 0
    for a, b in zip(want, got):
        for x, y in zip(a, b):
            assert math.isclose(x, y, rel_tol=1e-4) if isinstance(x, float) else x == y
