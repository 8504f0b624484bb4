import pytest
from pyspark.sql import functions as F

from cofan.operators import aggregates as A
from cofan.operators import quality as Q
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA
from tests.conftest import rows


def test_top_movies(ratings, movies):
    got = rows(A.top_movies(ratings, movies, 5), "movieId", "rating_count", "average_rating")
    assert got == [(1, 3, 4.833), (2571, 3, 4.667), (318, 3, 4.5), (79132, 2, 4.75), (2, 1, 5.0)]


def test_most_rated_ties_by_title(ratings, movies):
    got = rows(A.most_rated(ratings, movies, 5), "movieId", "rating_count")
    assert got == [(2571, 3), (318, 3), (1, 3), (79132, 2), (2, 1)]


def test_overview(ratings):
    r = A.overview(ratings).collect()[0]
    assert (r["rating_rows"], r["unique_users"], r["unique_movies_rated"]) == (12, 4, 5)
    assert abs(r["average_rating"] - 4.708333333) < 1e-6
    assert (r["minimum_rating"], r["maximum_rating"]) == (4.0, 5.0)
    ra = A.overview(ratings, approximate=True).collect()[0]
    assert (ra["unique_users"], ra["unique_movies_rated"]) == (4, 5)


def test_distribution(ratings):
    assert rows(A.rating_distribution(ratings), "rating", "rating_count") == [(4.0, 1), (4.5, 5), (5.0, 6)]


def test_unrated_none(ratings, movies):
    assert A.unrated_movies(movies, ratings).count() == 0


def test_count_includes_null_rating_mean_ignores(spark, movies):
    r = spark.createDataFrame([(1, 1, None, 1), (2, 1, 4.0, 2)], RATINGS_SCHEMA)
    got = rows(A.top_movies(r, movies, 5), "movieId", "rating_count", "average_rating")
    assert got == [(1, 2, 4.0)]


def test_row_counts(ratings, movies):
    assert sorted(rows(A.row_counts(ratings, movies), "table_name", "row_count")) == [("movies", 5), ("ratings", 12)]


def test_mean_group_count(ratings):
    assert A.mean_rating_group_count(ratings).collect()[0]["movie_groups"] == 5


def test_popular_only(spark, ratings, movies):
    from cofan.operators import corating

    recs = corating.recommend_for_ids(ratings, movies, corating.ids_frame(spark, [1], "int"), top_n=None)
    assert sorted(rows(A.popular_only(recs, ratings, 3), "movieId")) == [(318,), (2571,)]


def test_null_profile_and_keys(spark):
    m = spark.createDataFrame([(1, "A (2000)", None), (1, "B (2001)", "X"), (None, None, "Y")], MOVIES_SCHEMA)
    prof = {r["column_name"]: r["null_count"] for r in Q.null_profile(m, "movies").collect()}
    assert prof == {"movieId": 1, "title": 1, "genres": 1}
    k = Q.key_uniqueness(m, "movieId", "movies").collect()[0]
    assert (k["row_count"], k["distinct_keys"], k["duplicate_keys"], k["null_keys"]) == (3, 1, 1, 1)
    assert rows(Q.duplicate_keys(m, "movieId"), "movieId", "n") == [(1, 2)]


def test_cast_failures(spark):
    t = spark.createDataFrame([("1", "x", "4.5", "10"), ("bad", "y", "five", None), (None, "z", "1", "2")],
                              "userId string, movieId string, rating string, timestamp string")
    got = {r["column_name"]: (r["non_null"], r["failures"]) for r in Q.cast_failures(t, RATINGS_SCHEMA, "ratings").collect()}
    assert got == {"userId": (2, 1), "movieId": (3, 3), "rating": (3, 1), "timestamp": (2, 0)}


def test_contract_report(spark):
    from cofan.schemas import REQUIRED_COLUMNS

    h = spark.createDataFrame([("ratings.csv", ["userId", "movieId", "rating"])], "file_name string, columns array<string>")
    got = {r["file_name"]: (r["status"], r["missing"]) for r in Q.contract_report(h, REQUIRED_COLUMNS).collect()}
    assert got == {"ratings.csv": ("invalid", ["timestamp"]), "movies.csv": ("absent", ["genres", "movieId", "title"])}


def test_sample_vs_full(ratings, movies):
    from cofan.operators.compare import sample_vs_full

    got = {r["metric"]: (r["sample_value"], r["full_value"]) for r in sample_vs_full(ratings, movies, 6).collect()}
    assert got["rating_rows"] == (6.0, 12.0)
    assert got["unique_users"] == (2.0, 4.0)
    assert got["top10_same_rank"][1] == 10.0
    full = {r["metric"]: r["sample_value"] for r in sample_vs_full(ratings, movies, 100).collect()}
    assert full["top10_same_rank"] == 5.0  # five movies: same five ranks


@pytest.mark.parametrize("n", [0, 1, 1234, 4999, 5000, 9000])
def test_first_rows_equal_brute_force(spark, n):
    """With a column outside the key, no exchange reuse and no coalescing."""
    from cofan.operators.compare import first_rows

    settings = {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, "true") for k in settings}
    df = spark.range(5000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % 613).alias("userId"), (F.col("id") % 97).alias("movieId"),
        F.col("id").alias("timestamp"), F.lit(4.0).alias("rating"), F.col("id").cast("string").alias("extra"),
    ).repartition(7)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = [tuple(r) for r in first_rows(df, n).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    low = lambda r: (r[0] is not None, r[0] or 0, *r[1:4])
    assert sorted(got, key=low) == sorted((tuple(r) for r in df.collect()), key=low)[:n]
