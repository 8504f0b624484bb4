"""A user holding a third of all rating rows: the co-rating semi join on userId is
split by AQE's skew handling instead of landing in one task."""

import contextlib
import io

from pyspark.sql import functions as F

from cofan.operators import corating


def _final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


SKEW_CONF = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}
IDS = [1, 2, 2571, 79132, 318]
N = 30000


def _hot_user_ratings(spark):
    # user 0 owns every third row; the rest spread over 2000 users
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).cast("int").alias("userId"),
        F.element_at(F.array(*[F.lit(i) for i in IDS]), (F.col("id") % 5 + 1).cast("int")).alias("movieId"),
        F.lit(5.0).alias("rating"),
        F.col("id").alias("timestamp"),
    )


def _run(spark, make):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = make()
        rows = df.collect()
        return rows, _final_plan(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _brute(seed_ids):
    rows = [(0 if i % 3 == 0 else i % 2000 + 1, IDS[i % 5]) for i in range(N)]
    fans = {u for u, m in rows if m in seed_ids}
    expected = {}
    for u, m in rows:
        if u in fans and m not in seed_ids:
            expected[m] = expected.get(m, 0) + 1
    return expected


def test_hot_user_semi_join_is_split(spark, movies):
    ratings = _hot_user_ratings(spark)
    rows, plan = _run(spark, lambda: corating.recommend_similar(ratings, movies, "Toy Story", check=False))
    got = {r["movieId"]: r["fan_rating_count"] for r in rows}
    ids, n = IDS, N
    # brute force over the same generated rows
    rows = [(0 if i % 3 == 0 else i % 2000 + 1, ids[i % 5]) for i in range(n)]
    fans = {u for u, m in rows if m == 1}
    expected = {}
    for u, m in rows:
        if u in fans and m != 1:
            expected[m] = expected.get(m, 0) + 1
    assert got == expected
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true) [userId" in plan


def test_hot_user_batch_join_is_split(spark, movies):
    ratings = _hot_user_ratings(spark)
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "Jumanji")], "query_id string, query string")
    rows, plan = _run(spark, lambda: corating.recommend_batch(ratings, movies, seeds, top_n=10))
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], {})[r["movieId"]] = r["fan_rating_count"]
    assert got == {"a": _brute({1}), "b": _brute({2})}
    assert "SortMergeJoin(skew=true) [userId" in plan


def test_salted_fan_join_equals_plain_without_aqe(spark, movies):
    ratings = _hot_user_ratings(spark)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = corating.recommend_similar(ratings, movies, "Toy Story", check=False, salt_buckets=8)
        got = {r["movieId"]: r["fan_rating_count"] for r in df.collect()}
        plan = _final_plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == _brute({1})
    assert "_salt" in plan and "LeftSemi" in plan


def test_salted_batch_join_equals_plain(spark, movies):
    ratings = _hot_user_ratings(spark)
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "Jumanji")], "query_id string, query string")
    got = {}
    for r in corating.recommend_batch(ratings, movies, seeds, top_n=10, salt_buckets=8).collect():
        got.setdefault(r["query_id"], {})[r["movieId"]] = r["fan_rating_count"]
    assert got == {"a": _brute({1}), "b": _brute({2})}


def test_heavy_users_are_salted_by_default_without_aqe(spark, movies, monkeypatch):
    monkeypatch.setattr(corating, "HEAVY_LIKES", 5000)
    ratings = _hot_user_ratings(spark)
    assert [r["userId"] for r in corating.heavy_users(corating.likes(ratings)).collect()] == [0]
    seeds = spark.createDataFrame([("a", "Toy Story"), ("b", "Jumanji"), ("c", "inception")], "query_id string, query string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = corating.recommend_batch(ratings, movies, seeds, top_n=10)
        got = {}
        for r in df.collect():
            got.setdefault(r["query_id"], {})[r["movieId"]] = r["fan_rating_count"]
        plan = _final_plan(df)
        liked = corating.likes(ratings)
        fans = liked.filter("movieId = 1").selectExpr("'a' AS query_id", "userId").distinct()
        pairs = corating.fan_pairs(liked, fans, corating.heavy_users(liked), 16)
        sizes = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {"a": _brute({1}), "b": _brute({2}), "c": _brute({79132})}
    assert "_salt" in plan
    assert sum(sizes) == sum(1 for i in range(N) if _user(i) in _FANS)
    assert max(sizes) < 0.6 * sum(sizes)


def _user(i):
    return 0 if i % 3 == 0 else i % 2000 + 1


_FANS = {_user(i) for i in range(0, N, 5)}  # movie 1 is on every fifth row


def test_hot_gram_is_no_probe_of_longer_seeds(spark):
    from cofan.operators import matching

    titles = [(i, f"the thing number {i} (2000)", "X") for i in range(400)] + [(900, "the zyx (1999)", "X"), (901, "Other (1990)", "Y")]
    m = spark.createDataFrame(titles, "movieId int, title string, genres string")
    seeds = spark.createDataFrame([("a", "the zy"), ("b", "the qqq"), ("c", "er"), ("d", "e thing number 39"), ("e", "the zyx"), ("f", " ")], "query_id string, query string")
    s = matching.normalise_seeds(seeds)
    probes = {r["query_id"]: r["gram"] for r in matching.rarest_grams(m, s, [2, 3], 3, True).collect()}
    assert "b" not in probes and probes["a"] in (" zy", "e z") and probes["c"] == "er" and probes["d"] not in ("the", "thi", "ing")
    got = sorted((r["query_id"], r["movieId"]) for r in matching.match_seeds(m, seeds).collect())
    want = [("a", 900), ("e", 900)] + [(q, i) for q, k in (("c", "er"), ("d", "e thing number 39")) for i, t, _ in titles if k in t.lower()]
    assert got == sorted(want)
