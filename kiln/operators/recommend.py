"""Collaborative filtering with ``pyspark.ml`` ALS: rank search, test RMSE,
personal recommendations.

ALS itself is Spark's distributed block solver; the library only drives it, up to
``SPARK_RATINGS`` ratings.  Beyond, where a block outgrows a task, :mod:`kiln.operators.shards`
finds the same model from smaller shares.  Cold-start rows (a user or item unseen in training) are dropped from
scoring (``coldStartStrategy='drop'``) -- with NaN predictions kept, the
RMSE would be NaN and no rank could be chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators import shards
from kiln.operators.ratings import rmse, unrated_candidates, with_user_ratings
from kiln.session import checkpoint_dir, persisted  # noqa: F401 (re-exported)

# --- fixed values: the model settings of the original job --------------------
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.1
ALS_SEED = 1800009193
ALS_RANKS = (4, 8, 12)
#: user and item blocks.  The fitted model depends on them, so they are a fixed
#: parameter and not a property of the cluster; raise them with the data.
ALS_BLOCKS = 10
# ----------------------------------------------------------------------------
#: ratings that Spark's ALS fits: 2.5 million in each of its blocks
SPARK_RATINGS = 25_000_000


def make_als(rank: int = 10, max_iter: int = ALS_MAX_ITER, reg: float = ALS_REG_PARAM,
             seed: int = ALS_SEED, user: str = "userId", item: str = "movieId",
             label: str = "rating", blocks: int = ALS_BLOCKS) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol=user,
               itemCol=item, ratingCol=label, coldStartStrategy="drop",
               numUserBlocks=blocks, numItemBlocks=blocks)


def fit(train: DataFrame, rank: int, **kw) -> ALSModel:
    """Fit ALS (lineage is checkpointed every 10 iterations to the session's
    reliable checkpoint directory)."""
    with solver(train, **kw) as (solve, _):
        return solve(rank)


@contextmanager
def solver(train: DataFrame, **kw) -> Iterator[tuple[Callable[[int], ALSModel], bool]]:
    """``(solve, small)`` for the block: ``solve(rank)`` fits ALS to ``train``; if ``small``, by
    Spark's solver, and several at once are no trouble.  Else the ratings are dealt to shards
    here, once for all ranks."""
    checkpoint_dir(train.sparkSession)
    n = train.count()
    if n <= SPARK_RATINGS:
        yield lambda rank: make_als(rank, **kw).fit(train), True
    else:
        dealt = shards.deal(train, make_als(**kw), n)
        yield lambda rank: shards.fit(make_als(rank, **kw), dealt), False


def model_rmse(model: ALSModel, data: DataFrame) -> float:
    """RMSE of ``model`` on ``data`` (cold-start rows dropped)."""
    value = rmse(model.transform(data)).first()[0]
    if value is None:
        raise ValueError("no row of the evaluation set could be scored "
                         "(every user or item is unseen in training)")
    return float(value)


def model_score(model: ALSModel, data: DataFrame) -> DataFrame:
    """One row ``(rmse, n_scored, n_dropped)``: cold-start rows are left out of the
    RMSE and counted."""
    scored = model.transform(data)
    counted = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))).alias("rmse"),
                         F.count(F.lit(1)).alias("n_scored"))
    return counted.crossJoin(data.agg(F.count(F.lit(1)).alias("n"))).select(
        "rmse", "n_scored", (F.col("n") - F.col("n_scored")).alias("n_dropped"))


def rank_search(train: DataFrame, validation: DataFrame,
                ranks: Sequence[int] = ALS_RANKS, parallelism: int | None = None,
                **kw) -> tuple[DataFrame, ALSModel, int]:
    """Fit one model per rank on ``train`` and score it on ``validation``.

    Returns ``(table, best_model, best_rank)``; ``table`` has one row per
    rank: ``(rank, rmse, is_best)``, the lowest RMSE (first in ``ranks`` on
    ties) best.  Up to ``parallelism`` (default: all, or one if the ratings are
    many) candidates are fitted at once from driver threads, as Spark's own model
    tuners do; each fit is seeded, so the result does not depend on the interleaving.
    """
    spark: SparkSession = train.sparkSession
    ranks = list(ranks)
    # every fit scans the training set and every score the validation set:
    # build each once (fitted models do not depend on these caches)
    with persisted(train, validation) as (train, validation), solver(train, **kw) as (solve, small):
        def one(r: int) -> tuple[int, float, ALSModel]:
            model = solve(r)
            return r, model_rmse(model, validation), model
        with ThreadPoolExecutor(max_workers=parallelism or (len(ranks) if small else 1)) as pool:
            done = list(pool.map(one, ranks))
    results = [(r, e) for r, e, _ in done]
    best = min(done, key=lambda x: (x[1], ranks.index(x[0])))
    schema = T.StructType([T.StructField("rank", T.IntegerType()),
                           T.StructField("rmse", T.DoubleType()),
                           T.StructField("is_best", T.BooleanType())])
    table = spark.createDataFrame([(r, e, r == best[0]) for r, e in results], schema)
    return table, best[2], best[0]


def recommend_for_user(train: DataFrame, mine: DataFrame, movies: DataFrame,
                       user_id, rank: int, k: int = 25, **kw) -> tuple[DataFrame, ALSModel]:
    """Refit on ``train`` + the user's ratings with ``rank`` and return the
    ``k`` unrated items with the highest predicted rating:
    ``(movieId, title, userId, prediction)``, ties broken by id; and the model.

    The user's one factor row is a value beside the item factors, so candidates are
    joined on the item only; an item without factors has no prediction."""
    model = fit(with_user_ratings(train, mine), rank, **kw)
    cands = unrated_candidates(movies, mine, user_id)
    uid = user_id if isinstance(user_id, F.Column) else F.lit(user_id)
    own = model.userFactors.where(F.col("id") == uid).select("features").scalar()
    items = model.itemFactors.select(F.col("id").alias("movieId"), "features", own.alias("_own"))
    dot = F.aggregate(F.zip_with("features", "_own", lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0), lambda acc, x: acc + x).cast("float")
    pred = (items.select("movieId", dot.alias("prediction")).where(F.col("prediction").isNotNull())
            .join(cands, "movieId")
            .orderBy(F.col("prediction").desc(), F.col("movieId").asc()).limit(k))
    return pred.select("movieId", "title", "userId", "prediction"), model


def normal_equation_residuals(ratings: DataFrame, solved: DataFrame, fixed: DataFrame, by: str, other: str,
                              rank: int, reg: float = ALS_REG_PARAM, label: str = "rating") -> DataFrame:
    """``(id, n, residual)``: how far each row of ``solved`` is from solving its normal
    equations ``(sum y y' + reg * n * I) x = sum r y`` over its ``n`` ratings, ``y`` being the
    other side's factors ``fixed``.  ``residual`` is the largest component of the
    difference, relative to the largest of ``sum r y`` or 1.

    The product with ``x`` goes inside the sum, ``sum y (y'x - r) + reg * n * x``, so each
    rating adds two vectors and no matrix; the sums are plain aggregates, combined before
    the shuffle, so a user with a third of all ratings is no larger task than others.
    """
    x = solved.select(F.col("id").alias(by), F.col("features").cast("array<double>").alias("x"))
    y = fixed.select(F.col("id").alias(other), F.col("features").cast("array<double>").alias("y"))
    rows = ratings.select(by, other, F.col(label).cast("double").alias("r")).join(y, other).join(x, by)
    dot = reduce(Column.__add__, (F.col("x")[k] * F.col("y")[k] for k in range(rank)))
    rows = rows.select(by, "x", "y", "r", (dot - F.col("r")).alias("e"))
    sums = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *(F.max(F.col("x")[k]).alias(f"x{k}") for k in range(rank)),
        *(F.sum(F.col("y")[k] * F.col("e")).alias(f"d{k}") for k in range(rank)),
        *(F.sum(F.col("y")[k] * F.col("r")).alias(f"b{k}") for k in range(rank)))
    off = F.greatest(*(F.abs(F.col(f"d{k}") + reg * F.col("n") * F.col(f"x{k}")) for k in range(rank)))
    size = F.greatest(F.lit(1.0), *(F.abs(F.col(f"b{k}")) for k in range(rank)))
    return sums.select(F.col(by).alias("id"), "n", (off / size).alias("residual"))


def factor_predictions(model: ALSModel, data: DataFrame, rank: int, user: str = "userId",
                       item: str = "movieId") -> DataFrame:
    """``data`` with ``prediction`` computed from the factors by two joins; rows whose user or
    item has no factors are left out."""
    x = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("_x"))
    y = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("_y"))
    dot = reduce(Column.__add__, (F.col("_x")[k].cast("double") * F.col("_y")[k].cast("double") for k in range(rank)))
    return data.join(x, user).join(y, item).withColumn("prediction", dot).drop("_x", "_y")
