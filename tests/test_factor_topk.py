import numpy as np
import pytest

from cofan.operators import als as ALSOPS
from cofan.operators import factor_topk as K


def frame(spark, m, first=0):
    rows = [(first + k, [float(x) for x in v]) for k, v in enumerate(m)]
    return spark.createDataFrame(rows, "id int, features array<float>").repartition(3)


def check(spark, u, v, k):
    u, v = u.astype(np.float32), v.astype(np.float32)
    got = {}
    for r in K.top_items(frame(spark, u, 7), frame(spark, v, 1000), k).collect():
        got.setdefault(r["userId"] - 7, []).append((r["predicted_rating"], r["movieId"] - 1000))
    scores = u.astype(float) @ v.T.astype(float)
    assert sorted(got) == list(range(len(u)))
    for i, s in enumerate(scores):
        mine = sorted(got[i], reverse=True)
        assert len({j for _, j in mine}) == len(mine) == min(k, len(v))
        assert np.allclose([x for x, _ in mine], np.sort(s)[::-1][:k], rtol=1e-5, atol=1e-6)
        assert np.allclose([x for x, _ in mine], [s[j] for _, j in mine], rtol=1e-5, atol=1e-6)


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_pairs(spark, monkeypatch, small):
    if small:
        for name, n in (("TILE", 8), ("SHORT", 12), ("BLOCK", 40), ("ITEMS", 16), ("TILES", 3)):
            monkeypatch.setattr(K, name, n)
    rng = np.random.default_rng(3)
    u, v = rng.gamma(1, 1, (150, 5)), rng.gamma(1, 1, (200, 5))
    u[rng.random(u.shape) < 0.2] = 0
    u[4], u[9] = 0, [0, 0, 3, 0, 0]
    u[20:40] = u[20]  # one direction
    v[50:90] = v[v.sum(axis=1).argmax()]  # ties
    check(spark, u, v, 10)
    check(spark, rng.normal(size=(60, 3)), rng.normal(size=(90, 3)), 4)  # any sign


def test_few_items_and_none(spark):
    rng = np.random.default_rng(4)
    check(spark, rng.random((9, 2)), rng.random((3, 2)), 10)
    none = frame(spark, np.zeros((1, 2))).limit(0)
    assert K.top_items(none, frame(spark, rng.random((3, 2))), 5).count() == 0
    assert K.top_items(frame(spark, rng.random((3, 2))), none, 5).count() == 0


def test_most_pairs_are_not_scored(spark):
    """Candidates of the tiles are a small part of all items."""
    rng = np.random.default_rng(5)
    u, v = rng.gamma(9, 1, (4000, 3)), rng.gamma(9, 1, (6000, 3))
    users, items = frame(spark, u), frame(spark, v)
    tiles = K._tiles(users)
    head = tiles.select("tile", "c", "r").toArrow()
    tile, c, r = head.column("tile").to_numpy(), K._matrix(head.column("c")), K._matrix(head.column("r"))
    barred = K._barred(tiles, K._short_lists(items, tile, c), 10)
    least = {x["tile"]: x["least"] for x in barred.select("tile", "least").collect()}
    found = K._candidates(items, 1, tile, c, r, np.array([least[t] for t in tile.tolist()]))
    assert found.selectExpr("sum(size(ids))").first()[0] < len(tile) * len(v) / 10


def test_large_models_take_no_cross_join(spark, ratings, monkeypatch):
    model = ALSOPS.fit(ratings, maxIter=3)
    want = sorted(map(tuple, ALSOPS.recommend_all(model, 3).collect()))
    monkeypatch.setattr(ALSOPS, "PAIRS", 0, raising=False)
    recs = ALSOPS.recommend_all(model, 3)
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in recs._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, recs.collect()))
    assert recs.dtypes == ALSOPS.flatten(model.recommendForAllUsers(3)).dtypes
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-5)
