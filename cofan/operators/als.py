"""ALS collaborative-filtering workflow (Spark ML).

Fit on a sample split, predict, evaluate RMSE, recommend top-N for all users,
flatten the nested recommendations and attach titles, optionally keeping only
movies with enough ratings.  Iterative fitting checkpoints to the shared
``spark.checkpoint.dir`` (``cofan.session.checkpoint_dir``) so a lost executor
does not replay the whole lineage.  Ids beyond 32 bits go through ``operators.ids``.
"""

from __future__ import annotations

import math

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofan.operators.aggregates import rating_counts
from cofan.operators.factor_topk import top_items
from cofan.session import checkpoint_dir

# ---- fixed values (published experiment settings) ------------------------------
ALS_PARAMS = dict(rank=5, maxIter=5, regParam=0.1, nonnegative=True, coldStartStrategy="drop", seed=42)
SAMPLE_FRACTION = 0.05
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
# ----------------------------------------------------------------------------------

#: Pairs of users and items up to which Spark ML scores them all.
PAIRS = 1 << 26

#: Blocks of users and of items, Spark ML's default, and the ratings up to which one more
#: block is not needed: a task holds all of a block, several times over while it is built.
BLOCKS = 10
BLOCK_RATINGS = 1 << 22


def blocks_for(ratings: int) -> int:
    """Blocks of users (and of items) in which Spark ML fits so many ratings."""
    return max(BLOCKS, math.ceil(ratings / BLOCK_RATINGS))


def fit(train: DataFrame, checkpoint_interval: int = 10, **params) -> ALSModel:
    """The model of all rows of ``train``.  Tables of more than ``BLOCKS`` blocks of
    ``BLOCK_RATINGS`` are fitted in more blocks.  They are dealt by their user's block
    first, as a task keeps a buffer for each pair of blocks that it meets."""
    checkpoint_dir(train.sparkSession)
    p = {**ALS_PARAMS, **params}
    rows = train.select("userId", "movieId", "rating")
    blocks = blocks_for(rows.count())
    if blocks > BLOCKS:
        p = {"numUserBlocks": blocks, "numItemBlocks": blocks, **p}
        rows = rows.repartition(blocks, F.pmod(F.col("userId").cast("int"), F.lit(int(p["numUserBlocks"]))))
    als = ALS(userCol="userId", itemCol="movieId", ratingCol="rating",
              checkpointInterval=checkpoint_interval, **p)
    return als.fit(rows)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """``(userId, movieId, rating, prediction, prediction_clamped)``; the clamp keeps 0.5..5."""
    out = model.transform(test.select("userId", "movieId", "rating"))
    return out.select(
        "userId", "movieId", "rating", "prediction",
        F.least(F.greatest(F.col("prediction"), F.lit(0.5)), F.lit(5.0)).alias("prediction_clamped"),
    )


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(predictions)


def rmse_frame(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """RMSE as a DataFrame (optionally per group): ``sqrt(avg((rating - prediction)^2))``."""
    err = F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse")
    return predictions.groupBy(*(by or [])).agg(err, F.count(F.lit(1)).alias("n"))


def flatten(nested: DataFrame) -> DataFrame:
    """``(userId, movieId, predicted_rating)`` from Spark ML's ``(userId,
    recommendations array<struct<movieId, rating>>)``: one row per recommendation."""
    return nested.select("userId", F.inline("recommendations")).withColumnRenamed("rating", "predicted_rating")


def recommend_all(model: ALSModel, k: int = 10) -> DataFrame:
    """Top ``k`` items of every user in the model.  Spark ML scores every pair; a model
    of more than ``PAIRS`` pairs goes through ``factor_topk``, which gives the same
    scores and leaves out items that bounds exclude."""
    users, items = model.userFactors, model.itemFactors
    if users.count() * items.count() <= PAIRS:
        return flatten(model.recommendForAllUsers(int(k)))
    return top_items(users, items, int(k))


def recommend_for_users(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` for the users in ``users`` (a frame with ``userId``); unknown users
    have no rows."""
    return flatten(model.recommendForUserSubset(users.select(F.col("userId").cast("int").alias("userId")), int(k)))


def with_titles(flat: DataFrame, movies: DataFrame) -> DataFrame:
    """Left join to the dimension (recommended ids without metadata keep NULL titles)."""
    return flat.join(movies.select("movieId", "title", "genres"), "movieId", "left").select(
        "userId", "movieId", "title", "genres", "predicted_rating"
    )


def popular_recs(flat: DataFrame, movies: DataFrame, ratings: DataFrame, min_count: int = 20) -> DataFrame:
    """Recommendations for movies with at least ``min_count`` ratings (inner joins:
    the count filter rejects NULLs, so outer joins would add nothing)."""
    return (
        flat.join(movies.select("movieId", "title", "genres"), "movieId")
        .join(rating_counts(ratings, "num_ratings"), "movieId")
        .filter(F.col("num_ratings") >= int(min_count))
        .select("userId", "movieId", "title", "genres", "predicted_rating", "num_ratings")
    )


def experiment(ratings: DataFrame, fraction: float | None = None, weights=SPLIT_WEIGHTS,
               seed: int = SPLIT_SEED, **params):
    """Split and fit on all ratings, or on a sample of ``fraction`` of them when
    one is asked for: returns ``(model, train, test)``."""
    sample = ratings if fraction is None else ratings.sample(fraction=fraction, seed=seed)
    train, test = sample.randomSplit(list(weights), seed=seed)
    return fit(train, **params), train, test
