"""Behaviours listed as traps in the survey (T6, T12, T15, T18, T23)."""

from pyspark.sql import functions as F

from cofan.operators import aggregates as A
from cofan.operators import corating
from cofan.operators.matching import match_seed, match_seeds
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA


def test_substring_is_literal(spark):
    m = spark.createDataFrame(
        [(1, "100% Love (2001)", "A"), (2, "1000 Loves (2002)", "A"), (3, "a.b (2003)", "B"), (4, "axb (2004)", "B")],
        MOVIES_SCHEMA,
    )
    ids = lambda seed: sorted(r["movieId"] for r in match_seed(m, seed).collect())
    assert ids("0%") == [1]  # '%' is not a wildcard
    assert ids("a.b") == [3]  # '.' is not a regex
    seeds = spark.createDataFrame([("p", "0%"), ("d", "a.b")], "query_id string, query string")
    got = sorted((r["query_id"], r["movieId"]) for r in match_seeds(m, seeds).collect())
    assert got == [("d", 3), ("p", 1)]


def test_duplicate_dimension_ids_fan_out(spark):
    m = spark.createDataFrame([(1, "Seed (2000)", "A"), (2, "Dup (2001)", "X"), (2, "Dup (2001)", "Y")], MOVIES_SCHEMA)
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 5.0, 2)], RATINGS_SCHEMA)
    out = corating.recommend_similar(r, m, "seed").collect()
    assert sorted(x["genres"] for x in out) == ["X", "Y"]


def test_top_movies_second_key_is_rounded_mean(spark):
    m = spark.createDataFrame([(1, "B (2000)", "A"), (2, "A (2000)", "A")], MOVIES_SCHEMA)
    # means 4.0001 and 4.0004 both round to 4.0: the title decides, not the raw mean
    r = spark.createDataFrame(
        [(1, 1, 4.0001, 1), (2, 1, 4.0001, 2), (1, 2, 4.0004, 3), (2, 2, 4.0004, 4)], RATINGS_SCHEMA
    )
    got = [x["movieId"] for x in A.top_movies(r, m, 2).collect()]
    assert got == [2, 1]


def test_search_does_not_move_articles(spark):
    m = spark.createDataFrame([(1, "Matrix, The (1999)", "A")], MOVIES_SCHEMA)
    assert match_seed(m, "the matrix").count() == 0
    assert [r["tier"] for r in match_seed(m, "matrix, the").collect()] == [1]


def test_prediction_clamp(spark, ratings):
    from cofan.operators import als as ALSOPS

    model = ALSOPS.fit(ratings, maxIter=2)
    pred = ALSOPS.predict(model, ratings)
    bad = pred.filter((F.col("prediction_clamped") < 0.5) | (F.col("prediction_clamped") > 5.0)).count()
    assert bad == 0
    same_inside = pred.filter(
        (F.col("prediction") >= 0.5) & (F.col("prediction") <= 5.0) & (F.col("prediction") != F.col("prediction_clamped"))
    ).count()
    assert same_inside == 0
