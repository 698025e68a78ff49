"""Ratings analytics without a model: best-rated items, splits, baselines.

Inputs are ``(userId, movieId, rating)`` and ``(movieId, title)`` frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.buckets import md5_bucket

# --- fixed values: split weights and seed of the original job ---------------
SPLIT_WEIGHTS = (0.60, 0.20, 0.20)
SPLIT_SEED = 1800009193
# ----------------------------------------------------------------------------


#: rated items of one user up to which their ids are broadcast
BROADCAST_IDS = 100_000


def item_stats(ratings: DataFrame, item: str = "movieId", label: str = "rating") -> DataFrame:
    """``(item, count, average)`` per item (count ignores null ratings)."""
    return ratings.groupBy(item).agg(F.count(label).alias("count"),
                                     F.avg(label).alias("average"))


def top_rated(ratings: DataFrame, movies: DataFrame, min_reviews: int = 100,
              k: int = 20) -> DataFrame:
    """The ``k`` items with the highest average among those with at least
    ``min_reviews`` ratings: ``(movieId, title, count, average)``.

    Ratings are summed as decimals (15 digits after the point), so that an
    average does not depend on the order of the rows; ties are broken by id.
    The review filter runs on the grouped side before the join with the
    catalogue, so only qualifying items are joined.
    """
    exact = F.sum(F.col("rating").cast("decimal(30,15)")).cast("double")
    stats = (ratings.groupBy("movieId")
             .agg(F.count("rating").alias("count"), (exact / F.count("rating")).alias("average"))
             .where(F.col("count") >= min_reviews))
    return (stats.join(movies, "movieId").select("movieId", "title", "count", "average")
            .orderBy(F.col("average").desc(), F.col("movieId").asc()).limit(k))


def random_split(ratings: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
                 seed: int = SPLIT_SEED) -> list[DataFrame]:
    """``randomSplit`` as in the original job: reproducible only for the same
    input layout."""
    return ratings.randomSplit(list(weights), seed)


def md5_split(ratings: DataFrame, keys: Sequence[str] = ("userId", "movieId"),
              bounds: Sequence[int] = (60, 80),
              names: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Add ``split``: md5 bucket of the keys (0..99) below ``bounds[0]`` is the
    first split, below ``bounds[1]`` the second, the rest the third.  Stable
    under any re-partitioning and reproducible in SQL."""
    bucket = md5_bucket(*keys)
    return ratings.withColumn("split", F.when(bucket < bounds[0], names[0])
                              .when(bucket < bounds[1], names[1]).otherwise(names[2]))


def rmse(pred: DataFrame, prediction: str = "prediction", label: str = "rating") -> DataFrame:
    """One row ``rmse`` = sqrt(mean((prediction - label)^2)) over rows where
    both are present and not NaN."""
    ok = (F.col(prediction).isNotNull() & ~F.isnan(prediction) & F.col(label).isNotNull())
    err = F.pow(F.col(prediction) - F.col(label), 2)
    return pred.where(ok).agg(F.sqrt(F.avg(err)).alias("rmse"))


def mean_baseline_rmse(train: DataFrame, test: DataFrame, label: str = "rating") -> DataFrame:
    """One row ``(train_mean, rmse)``: the RMSE on ``test`` of always
    predicting the training mean.

    The mean is a scalar subquery (one aggregate job whose single value is
    put into the test plan); no driver round trip and no join.
    """
    mu = train.agg(F.avg(label)).scalar()
    with_mu = test.select(F.col(label).alias("_r"), mu.alias("_mu"))
    return with_mu.agg(F.first("_mu").alias("train_mean"),
                       F.sqrt(F.avg(F.pow(F.col("_r") - F.col("_mu"), 2))).alias("rmse"))


def mean_baseline_rmse_by_split(ratings: DataFrame, split: str = "split",
                                train: str = "train", test: str = "test",
                                label: str = "rating") -> DataFrame:
    """One row ``(train_mean, rmse)`` like :func:`mean_baseline_rmse`, for
    ratings that carry their split in a column: one aggregation pass.

    Uses ``mean((r - m)^2) = var_pop(r) + (mean(r) - m)^2`` over the test
    rows, with Spark's numerically stable central-moment aggregate, so the
    ratings are derived and read once instead of once per split.
    """
    r = F.col(label)
    in_train, in_test = F.col(split) == train, F.col(split) == test
    stats = ratings.agg(F.avg(F.when(in_train, r)).alias("train_mean"),
                        F.avg(F.when(in_test, r)).alias("_m"),
                        F.var_pop(F.when(in_test, r)).alias("_v"))
    return stats.select("train_mean",
                        F.sqrt(F.col("_v") + F.pow(F.col("_m") - F.col("train_mean"), 2))
                        .alias("rmse"))


def unrated_candidates(movies: DataFrame, rated: DataFrame, user_id,
                       item: str = "movieId") -> DataFrame:
    """Catalogue items the user has not rated, with ``userId`` added:
    ``(movieId, title, userId)`` (an anti join on the item id).  The rated ids
    are counted and, up to ``BROADCAST_IDS``, sent to the catalogue; beyond
    that the planner chooses."""
    uid = user_id if isinstance(user_id, F.Column) else F.lit(user_id)
    ids = rated.select(item).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return movies.join(ids, item, "left_anti").withColumn("userId", uid.cast("int"))


def with_user_ratings(train: DataFrame, mine: DataFrame) -> DataFrame:
    """Training ratings plus the user's own ratings (union by column name)."""
    cols = ["userId", "movieId", "rating"]
    return train.select(*cols).unionByName(mine.select(*cols))
