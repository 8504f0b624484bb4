import pytest
from pyspark.sql import functions as F

from cofan.operators import als as ALSOPS
from cofan.operators import ids as IDS
from cofan.operators import splits as SP


def test_hash_split_layout_independent(ratings):
    a = SP.hash_split_counts(ratings, 50, 50).collect()[0]
    b = SP.hash_split_counts(ratings.repartition(5), 50, 50).collect()[0]
    assert a == b
    train, test = SP.hash_split(ratings, 80)
    assert train.count() + test.count() == 12
    assert train.join(test, ["userId", "movieId", "timestamp"]).count() == 0


def test_als_workflow(ratings, movies):
    model = ALSOPS.fit(ratings, maxIter=2)
    pred = ALSOPS.predict(model, ratings)
    assert pred.count() == 12
    r = ALSOPS.rmse_frame(pred).collect()[0]
    assert r["n"] == 12 and r["rmse"] >= 0
    flat = ALSOPS.recommend_all(model, 3)
    assert flat.columns == ["userId", "movieId", "predicted_rating"]
    assert flat.groupBy("userId").count().filter(F.col("count") != 3).count() == 0
    titled = ALSOPS.with_titles(flat, movies)
    assert titled.filter(F.col("title").isNull()).count() == 0
    pop = ALSOPS.popular_recs(flat, movies, ratings, 3)
    assert pop.filter(F.col("num_ratings") < 3).count() == 0


def test_als_user_subset(spark, ratings):
    model = ALSOPS.fit(ratings, maxIter=2)
    users = spark.createDataFrame([(1,), (3,)], "userId int")
    recs = ALSOPS.recommend_for_users(model, users, 2)
    assert sorted({r["userId"] for r in recs.collect()}) == [1, 3]


def test_checkpoint_dir_reads_session_setting(spark):
    from cofan.session import checkpoint_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured
    assert configured in spark.sparkContext.getCheckpointDir()


def test_nested_recommendations_are_exploded(spark, ratings):
    model = ALSOPS.fit(ratings, maxIter=3)
    nested = model.recommendForAllUsers(3)
    want = sorted((r["userId"], x["movieId"], x["rating"]) for r in nested.collect() for x in r["recommendations"])
    assert len(want) == 12 and sorted(map(tuple, ALSOPS.recommend_all(model, 3).collect())) == want
    empty = nested.limit(0)
    assert ALSOPS.flatten(empty).columns == ["userId", "movieId", "predicted_rating"] and ALSOPS.flatten(empty).count() == 0


def test_dense_index_numbers_in_key_order(spark):
    keys = [5 << 40, -3, 7, 7, None, 1 << 33, 0] + list(range(100, 400, 3))
    df = spark.createDataFrame([(k, "x") for k in keys], "userId long, idx string").repartition(6)
    got = sorted(tuple(r) for r in IDS.dense_index(df, "userId", "n").collect())
    assert got == [(k, n) for n, k in enumerate(sorted({k for k in keys if k is not None}))]
    assert IDS.dense_index(df.limit(0), "userId", "n").count() == 0


def test_more_keys_than_ints_are_refused(spark, monkeypatch):
    monkeypatch.setattr(IDS, "MAX_IDS", 3)
    with pytest.raises(ValueError, match="32-bit"):
        IDS.dense_index(spark.range(4).withColumnRenamed("id", "userId"), "userId", "n")


def test_wide_ids_fit_and_map_back(spark, ratings):
    wide = ratings.select((F.col("userId") + (1 << 40)).alias("userId"), (F.col("movieId") - (1 << 35)).alias("movieId"), "rating")
    indexed, users, items = IDS.index_ratings(wide)
    assert indexed.schema["userId"].dataType.simpleString() == "int" and indexed.count() == 12
    back = IDS.restore(ALSOPS.predict(ALSOPS.fit(indexed, maxIter=2), indexed), users, items)
    assert sorted((r["userId"], r["movieId"], r["rating"]) for r in back.collect()) == sorted(tuple(r) for r in wide.collect())


def test_users_the_model_does_not_know(spark, ratings):
    model = ALSOPS.fit(ratings, maxIter=2)
    users = spark.createDataFrame([(1,), (1,), (404,), (None,)], "userId long")
    assert {r["userId"] for r in ALSOPS.recommend_for_users(model, users, 2).collect()} == {1}
