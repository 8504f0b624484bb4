"""Physical-plan properties checked through the public ``explain`` output."""

import contextlib
import io

from cofan.operators import aggregates as A
from cofan.operators import corating


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_recommendation_has_semi_anti_joins_and_no_in_list(ratings, movies):
    p = plan_text(corating.recommend_similar(ratings, movies, "Toy Story", check=False))
    assert "LeftSemi" in p and "LeftAnti" in p
    assert "InSet" not in p
    assert "TakeOrderedAndProject" in p


def test_filters_and_columns_reach_parquet_scan(spark, ratings, movies, tmp_path):
    ratings.write.parquet(str(tmp_path / "r"))
    r = spark.read.parquet(str(tmp_path / "r"))
    p = plan_text(corating.recommend_similar(r, movies, "Toy Story", check=False))
    assert "GreaterThanOrEqual(rating,4.5)" in p
    assert "ReadSchema: struct<userId:int,movieId:int,rating:double>" in p


def test_aggregate_before_dimension_join(ratings, movies):
    p = plan_text(A.top_movies(ratings, movies, 5))
    assert "partial_count" in p and "partial_avg" in p
    # map-side partial aggregation, one shuffle on the movie key, then the join
    assert "hashpartitioning(movieId" in p
    tree = p.split("\n\n")[0]
    assert tree.index("Join") < tree.rindex("HashAggregate")


def test_batch_top_k_uses_group_limit(spark, ratings, movies):
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "the")], "query_id string, query string")
    p = plan_text(corating.recommend_batch(ratings, movies, seeds, top_n=3))
    assert "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_gram_index_is_never_the_broadcast_side(spark, movies):
    import re

    from cofan.operators.matching import match_seeds

    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "the")], "query_id string, query string")
    p = plan_text(match_seeds(movies, seeds))
    inputs = re.findall(r"\) BroadcastExchange\s*\nInput \[\d+\]: \[([^\]]*)\]", p)
    assert inputs, p
    for cols in inputs:
        assert "lower_title" not in cols


def test_overview_copies_no_row_and_scans_twice(spark, ratings, tmp_path):
    ratings.write.parquet(str(tmp_path / "r"))
    p = plan_text(A.overview(spark.read.parquet(str(tmp_path / "r"))))
    tree = p.split("\n\n")[0]
    assert "Expand" not in p and p.count("ReadSchema: ") == 2, tree
