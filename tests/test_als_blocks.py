"""Blocks of the ALS fit grow with the ratings, so that a task's share does not."""

import numpy as np

from cofan.operators import als as ALSOPS
from cofan.operators import factor_topk as K


def asked(monkeypatch, train, **params):
    seen = {}
    real = ALSOPS.ALS

    def spied(**p):
        seen.update(p)
        return real(**p)

    monkeypatch.setattr(ALSOPS, "ALS", spied)
    return ALSOPS.fit(train, maxIter=5, **params), seen


def test_more_ratings_take_more_blocks(spark, monkeypatch):
    train = spark.range(3000).selectExpr("cast(id % 97 as int) userId", "cast(id % 101 as int) movieId", "cast(id % 5 + 1 as double) rating")
    small, seen = asked(monkeypatch, train)
    assert "numUserBlocks" not in seen  # as ever for small tables
    assert ALSOPS.blocks_for(216_000_000) == 52
    monkeypatch.setattr(ALSOPS, "BLOCK_RATINGS", 100, raising=False)
    model, seen = asked(monkeypatch, train)
    assert seen["numUserBlocks"] == seen["numItemBlocks"] == 30
    assert model.userFactors.count() == 97 and model.itemFactors.count() == 101
    pred, want = ALSOPS.predict(model, train), ALSOPS.predict(small, train)
    assert pred.count() == 3000 and abs(ALSOPS.rmse(pred) - ALSOPS.rmse(want)) < 0.2


def test_short_lists_hold_a_partitions_best_only(spark, monkeypatch):
    """Not those of each batch: rows grow with tiles and partitions alone."""
    for name, n in (("SHORT", 4), ("TILES", 3)):
        monkeypatch.setattr(K, name, n)
    rng = np.random.default_rng(6)
    items, c = rng.random((300, 3)).astype(np.float32), rng.random((7, 3))
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(items)], "id int, features array<float>").repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    rows = []
    try:
        real = type(df).mapInArrow
        monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: rows.append(real(self, f, schema)) or rows[-1])
        got = K._short_lists(df, np.arange(7), c).collect()
        made = rows[0].count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert made <= 2 * 7 * 4  # 7 x 4 for each of 30 batches before
    for r in got:
        mine = np.array(r["shorts"]).reshape(-1, 3) @ c[r["tile"]]
        assert np.allclose(np.sort(mine), np.sort(items.astype(float) @ c[r["tile"]])[-4:])
