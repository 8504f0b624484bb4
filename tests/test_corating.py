import pytest
from pyspark.sql import functions as F

from cofan.operators import corating
from cofan.operators.matching import match_seed
from tests.conftest import rows


def rec(ratings, movies, seed, **kw):
    return rows(corating.recommend_similar(ratings, movies, seed, top_n=kw.pop("top_n", 10), **kw),
                "movieId", "fan_rating_count")


def test_exact_seed(ratings, movies):
    assert rec(ratings, movies, "Toy Story") == [(79132, 2), (2571, 2), (318, 2)]


def test_full_title_takes_substring_tier(ratings, movies):
    assert rec(ratings, movies, "toy story (1995)") == [(79132, 2), (2571, 2), (318, 2)]


def test_threshold_inclusive(ratings, movies):
    assert rec(ratings, movies, "Toy Story", min_rating=5.0) == [(79132, 1), (2571, 1)]


def test_matrix(ratings, movies):
    assert rec(ratings, movies, "The Matrix") == [(1, 2), (79132, 1), (2, 1), (318, 1)]


def test_jumanji_below_threshold(ratings, movies):
    assert rec(ratings, movies, "Jumanji") == [(2571, 1)]


def test_substring_all_sources_excluded(ratings, movies):
    # "the" hits "The Matrix" and "The Shawshank Redemption": both are sources.
    assert rec(ratings, movies, "the") == [(1, 3), (79132, 2), (2, 1)]


def test_top_n_cut(ratings, movies):
    assert rec(ratings, movies, "Toy Story", top_n=2) == [(79132, 2), (2571, 2)]


@pytest.mark.parametrize("seed", ["", "   "])
def test_blank_seed_raises(ratings, movies, seed):
    with pytest.raises(ValueError):
        corating.recommend_similar(ratings, movies, seed)


def test_no_match_raises(ratings, movies):
    with pytest.raises(ValueError, match="no title equals"):
        corating.recommend_similar(ratings, movies, "zzz")


def test_keep_source(spark, ratings, movies):
    out = corating.recommend_for_ids(ratings, movies, corating.ids_frame(spark, [1], "int"), exclude_sources=False)
    assert rows(out, "movieId", "fan_rating_count") == [(1, 3), (79132, 2), (2571, 2), (318, 2)]


def test_counts_rows_not_users(spark, movies):
    from cofan.schemas import RATINGS_SCHEMA

    r = spark.createDataFrame(
        [(1, 1, 5.0, 1), (1, 2, 5.0, 2), (1, 2, 5.0, 3), (2, 1, 5.0, 4), (2, 2, 4.5, 5)], RATINGS_SCHEMA
    )
    assert rec(r, movies, "Toy Story") == [(2, 3)]


def test_fans_deduplicated_across_sources(spark):
    from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

    m = spark.createDataFrame([(1, "Saga I (2000)", "A"), (2, "Saga II (2001)", "A"), (3, "Other (2002)", "B")],
                              MOVIES_SCHEMA)
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 5.0, 2), (1, 3, 5.0, 3)], RATINGS_SCHEMA)
    # user 1 likes both sources; movie 3 is counted once.
    assert rec(r, m, "saga") == [(3, 1)]


def test_null_source_id_does_not_empty_result(spark):
    from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

    m = spark.createDataFrame([(None, "Toy Story (1995)", "A"), (1, "Toy Story (1995)", "A"), (2, "Other (2000)", "B")],
                              MOVIES_SCHEMA)
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 5.0, 2)], RATINGS_SCHEMA)
    assert rec(r, m, "Toy Story") == [(2, 1)]


def test_tie_break_by_id(spark):
    from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

    m = spark.createDataFrame([(1, "Seed (2000)", "A"), (9, "Same (2001)", "B"), (5, "Same (2001)", "B")], MOVIES_SCHEMA)
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 9, 5.0, 2), (1, 5, 5.0, 3)], RATINGS_SCHEMA)
    assert rec(r, m, "seed", top_n=1) == [(5, 1)]


def test_metadata_join_inner_before_limit(spark):
    from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

    m = spark.createDataFrame([(1, "Seed (2000)", "A"), (3, "Known (2001)", "B")], MOVIES_SCHEMA)
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 5.0, 2), (2, 1, 5.0, 3), (2, 2, 5.0, 4), (1, 3, 5.0, 5)],
                              RATINGS_SCHEMA)
    # movie 2 has the highest count but no metadata: dropped without using a slot.
    assert rec(r, m, "seed", top_n=1) == [(3, 1)]


def test_match_tiers(movies):
    assert sorted(r["movieId"] for r in match_seed(movies, "the matrix").collect()) == [2571]
    assert sorted(r["movieId"] for r in match_seed(movies, "THE").collect()) == [318, 2571]
    assert match_seed(movies, "the matrix (1999)").collect()[0]["tier"] == 2


def test_batch_equals_single_calls(spark, ratings, movies):
    seeds = spark.createDataFrame(
        [("a", "Toy Story"), ("b", "the"), ("c", "The Matrix"), ("d", "zzz"), ("e", "  "), ("f", "toy story (1995)")],
        "query_id string, query string",
    )
    batch = corating.recommend_batch(ratings, movies, seeds, top_n=10)
    got = {}
    for r in batch.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["movieId"], r["fan_rating_count"]))
    expected = {
        "a": rec(ratings, movies, "Toy Story"),
        "b": rec(ratings, movies, "the"),
        "c": rec(ratings, movies, "The Matrix"),
        "f": rec(ratings, movies, "toy story (1995)"),
    }
    assert got == expected


def test_seed_status(spark, movies):
    from cofan.operators.matching import match_seeds, seed_status

    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "the"), ("d", "zzz"), ("e", "  ")],
                                  "query_id string, query string")
    st = {r["query_id"]: (r["status"], r["source_count"])
          for r in seed_status(seeds, match_seeds(movies, seeds)).collect()}
    assert st == {"a": ("exact", 1), "b": ("substring", 2), "d": ("no_match", 0), "e": ("blank", 0)}


def test_short_seeds_use_short_grams(spark, movies):
    from cofan.operators.matching import match_seeds

    seeds = spark.createDataFrame([("x", "x"), ("ji", "ji"), ("i", "i")], "query_id string, query string")
    got = {}
    for r in match_seeds(movies, seeds).collect():
        got.setdefault(r["query_id"], set()).add(r["movieId"])
    titles = {m: t.lower() for m, t, _ in __import__("tests.conftest", fromlist=["MOVIES"]).MOVIES}
    for q in ("x", "ji", "i"):
        assert got.get(q, set()) == {m for m, t in titles.items() if q in t}


def test_result_summary(ratings, movies):
    s = corating.result_summary(corating.recommend_similar(ratings, movies, "Toy Story")).collect()[0]
    assert (s["result_rows"], s["total_signals"], s["genres_represented"]) == (3, 6, 5)


def test_plan_uses_semi_and_anti_joins_without_collect(ratings, movies):
    plan = corating.recommend_similar(ratings, movies, "Toy Story", check=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan
    assert "InSet" not in plan and " IN (" not in plan


def test_result_summary_edges(spark):
    recs = spark.createDataFrame(
        [(1, "A", "Drama|(no genres listed)", 3), (2, "B", None, 2), (3, "C", "(no genres listed)", 1)],
        "movieId int, title string, genres string, fan_rating_count long",
    )
    s = corating.result_summary(recs).collect()[0]
    assert (s["result_rows"], s["total_signals"], s["genres_represented"]) == (3, 6, 1)
    empty = corating.result_summary(recs.limit(0)).collect()[0]
    assert (empty["result_rows"], empty["genres_represented"]) == (0, 0)
    by = {r["g"]: r["result_rows"] for r in corating.result_summary(
        recs.withColumn("g", (recs.movieId % 2).cast("int")), ["g"]).collect()}
    assert by == {0: 1, 1: 2}


def test_large_seed_table_uses_shuffle_join(spark, ratings, movies, monkeypatch):
    from cofan.operators import joins, matching

    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 1)
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "the"), ("c", "ji")], "query_id string, query string")
    got = sorted((r["query_id"], r["movieId"], r["tier"]) for r in matching.match_seeds(movies, seeds).collect())
    assert got == [("a", 1, 1), ("b", 318, 2), ("b", 2571, 2), ("c", 2, 2)]


def test_size_check_counts_bytes(spark):
    from cofan.operators import joins

    df = spark.createDataFrame([("a" * 1000, 1)] * 50, "q string, n long")
    assert joins.at_most(df, 100, 1_000_000)
    assert not joins.at_most(df, 100, 10_000)  # 50 x 1008 bytes
    assert not joins.at_most(df, 10, 1_000_000)


def test_batch_edge_inputs(spark, ratings, movies):
    from cofan.schemas import MOVIES_SCHEMA

    empty = spark.createDataFrame([], "query_id string, query string")
    assert corating.recommend_batch(ratings, movies, empty).count() == 0
    blanks = spark.createDataFrame([("a", "  "), ("b", None)], "query_id string, query string")
    assert corating.recommend_batch(ratings, movies, blanks).count() == 0
    with_nulls = movies.unionByName(spark.createDataFrame([(7, None, None), (8, "", "X")], MOVIES_SCHEMA))
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "y")], "query_id string, query string")
    got = {}
    for r in corating.recommend_batch(ratings, with_nulls, seeds).collect():
        got.setdefault(r["query_id"], []).append((r["movieId"], r["fan_rating_count"]))
    assert got["a"] == rec(ratings, movies, "Toy Story")
    assert got["b"] == rec(ratings, movies, "y")
