"""Ratings operators: candidates (A8), splits, baseline RMSE, ALS cold start (B5)."""

import math

from pyspark.sql import functions as F

from kiln.operators import ratings as rt
from kiln.operators import recommend as rc
from kiln.plans.catalog import MY_RATINGS
from kiln.sources.readers import RATING_SCHEMA


def test_unrated_candidates_use_movie_ids(spark):
    movies = spark.createDataFrame([(m, f"t{m}") for m in (2, 3, 50, 260, 999)],
                                   "movieId int, title string")
    mine = spark.createDataFrame([(0, m, r) for m, r in MY_RATINGS], RATING_SCHEMA)
    got = sorted(r["movieId"] for r in rt.unrated_candidates(movies, mine, 0).collect())
    assert got == [2, 3, 999]


def test_md5_split_is_disjoint_and_covers(spark):
    r = spark.range(0, 3000).select((F.col("id") % 97).cast("int").alias("userId"),
                                    (F.col("id") % 89).cast("int").alias("movieId"),
                                    F.lit(3.0).alias("rating"))
    s = rt.md5_split(r)
    counts = {x["split"]: x["count"] for x in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000 and set(counts) == {"train", "validation", "test"}
    again = rt.md5_split(r.repartition(7))
    assert s.exceptAll(again).count() == 0


def test_top_rated_filters_before_join_and_breaks_ties(spark):
    ratings = spark.createDataFrame([(1, 1, 5.0), (2, 1, 5.0), (1, 2, 5.0), (2, 2, 5.0),
                                     (1, 3, 1.0), (2, 3, 2.0), (1, 4, 5.0)],
                                    "userId int, movieId int, rating double")
    movies = spark.createDataFrame([(i, f"m{i}") for i in range(1, 5)], "movieId int, title string")
    got = [tuple(r) for r in rt.top_rated(ratings, movies, 2, 2).collect()]
    assert got == [(1, "m1", 2, 5.0), (2, "m2", 2, 5.0)]


def test_top_rated_compares_exact_averages(spark):
    """Means of 4.999750125 and 4.99975 are not tied."""
    rows = [(u, 1, 5.0 if u else 4.000500) for u in range(4000)] + [(u, 2, 5.0 if u else 4.0) for u in range(4000)]
    ratings = spark.createDataFrame([(u, 3 - m, r) for u, m, r in rows], RATING_SCHEMA)
    movies = spark.createDataFrame([(1, "a"), (2, "b")], "movieId int, title string")
    got = rt.top_rated(ratings, movies, 1, 2).collect()
    assert [r["movieId"] for r in got] == [2, 1] and got[0]["average"] > got[1]["average"]


def test_mean_baseline_rmse(spark):
    train = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0)], "userId int, movieId int, rating double")
    test = spark.createDataFrame([(2, 1, 1.0), (2, 2, 5.0)], "userId int, movieId int, rating double")
    row = rt.mean_baseline_rmse(train, test).first()
    assert row["train_mean"] == 3.0 and math.isclose(row["rmse"], 2.0)


def test_als_cold_start_dropped(spark):
    train = spark.createDataFrame([(u, i, float((u + i) % 5 + 1)) for u in range(6) for i in range(6)],
                                  "userId int, movieId int, rating double")
    test = spark.createDataFrame([(0, 1, 3.0), (99, 1, 3.0), (1, 99, 3.0)],
                                 "userId int, movieId int, rating double")
    model = rc.fit(train, 2, max_iter=3)
    assert model.transform(test).count() == 1
    assert math.isfinite(rc.model_rmse(model, test))
    table, best, rank = rc.rank_search(train, train, ranks=(2, 3), max_iter=3)
    assert table.count() == 2 and table.where("is_best").first()["rank"] == rank


def test_recommend_for_user(spark):
    train = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(1, 8) for i in range(1, 9)],
                                  "userId int, movieId int, rating double")
    movies = spark.createDataFrame([(i, f"m{i}") for i in range(1, 9)], "movieId int, title string")
    mine = spark.createDataFrame([(0, 1, 5.0), (0, 2, 1.0)], RATING_SCHEMA)
    recs, model = rc.recommend_for_user(train, mine, movies, 0, rank=2, k=3, max_iter=3)
    got = recs.collect()
    assert len(got) == 3 and all(r["movieId"] not in (1, 2) for r in got)
    preds = [r["prediction"] for r in got]
    assert preds == sorted(preds, reverse=True)
    cands = rt.unrated_candidates(movies, mine, 0)
    want = {r["movieId"]: r["prediction"] for r in model.transform(cands).collect()}
    assert all(math.isclose(r["prediction"], want[r["movieId"]], rel_tol=1e-5) for r in got)
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (movieId" in plan and "userId" not in plan.split("Join Inner")[1].splitlines()[0]


def _als_fixture(spark):
    rows = [(u, i, float((3 * u + i * i) % 5 + 1)) for u in range(12) for i in range(15) if (u + i) % 3]
    return rows, spark.createDataFrame(rows, RATING_SCHEMA)


def test_als_user_factors_solve_their_normal_equations(spark):
    """The last half step fits each user to the returned item factors:
    (sum of v v' + reg n I) u = sum of rating v."""
    import numpy as np
    rows, train = _als_fixture(spark)
    model = rc.fit(train, 3)
    items = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    for r in model.userFactors.collect():
        mine = [(items[i], x) for u, i, x in rows if u == r["id"]]
        a = sum(np.outer(v, v) for v, _ in mine) + rc.ALS_REG_PARAM * len(mine) * np.eye(3)
        assert np.allclose(a @ np.array(r["features"], float), sum(x * v for v, x in mine), rtol=1e-3, atol=1e-3)


def test_model_score_from_the_factors(spark):
    import numpy as np
    rows, train = _als_fixture(spark)
    model = rc.fit(train, 2)
    test = spark.createDataFrame([(0, 0, 2.0), (3, 3, 5.0), (99, 1, 1.0), (1, 99, 1.0), (5, 2, 4.0)], RATING_SCHEMA)
    users = {r["id"]: np.array(r["features"], float) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    err = [(users[u] @ items[i] - x) ** 2 for u, i, x in ((0, 0, 2.0), (3, 3, 5.0), (5, 2, 4.0))]
    score = rc.model_score(model, test).first()
    assert math.isclose(score["rmse"], math.sqrt(sum(err) / 3), rel_tol=1e-5)
    assert (score["n_scored"], score["n_dropped"]) == (3, 2)
    assert math.isclose(rc.model_rmse(model, test), score["rmse"], rel_tol=1e-9)


def test_als_blocks_are_fixed():
    assert rc.make_als().getNumUserBlocks() == rc.make_als().getNumItemBlocks() == rc.ALS_BLOCKS


def test_random_split_weights(spark):
    r = spark.range(0, 5000).select(F.col("id").cast("int").alias("userId"),
                                    F.lit(1).alias("movieId"), F.lit(3.0).alias("rating"))
    parts = rt.random_split(r)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and 2700 < sizes[0] < 3300 and 800 < sizes[1] < 1200
    assert parts[0].join(parts[2], "userId").count() == 0


def test_baseline_by_split_equals_two_frame_form(spark):
    rows = [(u, m, float((u * 7 + m * 3) % 5 + 1) + 1e6, ["train", "test", "validation"][(u + m) % 3])
            for u in range(30) for m in range(20)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, split string")
    one = rt.mean_baseline_rmse_by_split(df).first()
    two = rt.mean_baseline_rmse(df.where("split = 'train'"), df.where("split = 'test'")).first()
    assert math.isclose(one["train_mean"], two["train_mean"], rel_tol=1e-12)
    assert math.isclose(one["rmse"], two["rmse"], rel_tol=1e-9)


def test_ratings_join_splits_a_hot_order(spark):
    """Half of all line items on one order: the ratings join is planned as a
    skew-split join (thresholds lowered to fixture size) and still gives the
    brute-force result."""
    import os
    import tempfile
    from collections import defaultdict
    from kiln.plans import bindings as b
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    n = 8000
    li = [(7 if i < n // 2 else i % 300, i % 97, float(i % 50 + 1)) for i in range(n)]
    od = [(o, o % 40) for o in range(300)]
    d = tempfile.mkdtemp(prefix="kiln-skew-")
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_quantity double") \
        .repartition(8).write.parquet(os.path.join(d, "lineitem.parquet"))
    spark.createDataFrame(od, "o_orderkey long, o_custkey long").write.parquet(
        os.path.join(d, "orders.parquet"))
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        r = b.ratings(spark, d)
        got = {(x["userId"], x["movieId"]): x["rating"] for x in r.collect()}
        assert "skew=true" in r._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cust = dict(od)
    acc = defaultdict(list)
    for o, p, q in li:
        acc[(cust[o], p)].append(1 + (int(q) - 1) % 5)
    expect = {k: sum(v) / len(v) for k, v in acc.items()}
    assert got.keys() == expect.keys()
    assert all(math.isclose(got[k], expect[k]) for k in expect)


def test_normal_equations_and_factor_products(spark):
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(12) for i in range(9) if (u + i) % 4]
    train = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    model = rc.fit(train, 3)
    res = rc.normal_equation_residuals(train, model.userFactors, model.itemFactors, "userId", "movieId", 3)
    got = {r["id"]: (r["n"], r["residual"]) for r in res.collect()}
    assert {u: n for u, (n, _) in got.items()} == {u: sum(r[0] == u for r in rows) for u in range(12)}
    assert max(x for _, x in got.values()) < 1e-4
    # other ratings are not what these factors solve
    other = train.withColumn("rating", train.rating + 1)
    off = rc.normal_equation_residuals(other, model.userFactors, model.itemFactors, "userId", "movieId", 3)
    assert min(r["residual"] for r in off.collect()) > 1e-2
    own = {(r.userId, r.movieId): r.prediction for r in rc.factor_predictions(model, train, 3).collect()}
    assert all(abs(own[r.userId, r.movieId] - r.prediction) < 1e-5 for r in model.transform(train).collect())
