"""Hard negatives against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from cofan.llm import hard_negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, a string, bits int"


def brute(rows, n_pos=5, n_neg=3):
    good = [(i, c, [math.floor(256 * x) for x in v]) for i, v, c, *_ in rows if None not in (i, v, c) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, own, v in dict.fromkeys((i, c, tuple(v)) for i, c, v in good if i % 50 == 0):
        others = sorted((-sum(a * b for a, b in zip(v, w)), i, c) for i, c, w in good if i != q)
        for s, p, _ in [x for x in others if x[2] == own][:n_pos]:
            near = [x for x in others if x[2] != own and -50 * s <= -100 * x[0] <= -95 * s][:n_neg]
            out += [(q, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(near)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 50 == 0).collect())


def test_lookups_are_the_inner_products():
    rng = np.random.default_rng(2)
    for width, high in ((8, 3), (64, 300), (24, 1 << 20)):
        c = rng.integers(-high, high, (300, width))
        c[0], c[1] = -high, high - 1
        planes = 1 + int(high - 1).bit_length()
        bits = hard_negatives.bit_planes(c, planes)
        assert (hard_negatives.components(bits) == c).all()
        assert (hard_negatives.scores(c[:40], bits) == c[:40] @ c.T).all()


def test_equals_brute_force_over_many_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(3, 12))
    # One label holds most rows; copies tie.
    rows = [(i, [float(np.float32(x)) for x in centre[i % 3] + rng.normal(size=12)], 0 if i % 3 else i % 7, "x", 1) for i in range(900)]
    rows += [(1000 + i, rows[7][1], i % 2, "x", 1) for i in range(30)] + [rows[50], rows[3]]
    for name, value in (("CELL", 64), ("LEAST_CELL", 16), ("BLOCK", 3), ("TILE", 2), ("CHUNK", 17)):
        monkeypatch.setattr(hard_negatives, name, value)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    # An id given twice with one text is one anchor, but two candidates.
    assert got(df) == brute(rows)


def test_edges(spark):
    rows = [
        (0, [1.0, 0.5], 1, None, None), (50, [], 1, "x", 0), (1, None, 1, "x", 0), (2, [None, 1.0], 1, "x", 0), (3, [float("nan")], 1, "x", 0),
        (4, [float("inf"), 1.0], 2, "x", 0), (5, [1.0, 1.0], None, "x", 0), (None, [1.0, 1.0], 2, "x", 0), (6, [0.5, 0.5], 2, "x", 0),
        (7, [0.5, 0.5], 2, "x", 0), (8, [1.0], 1, "x", 0), (9, [-1.0, 0.0, 3.0], 1, "x", 0), (100, [-1.0], 2, "x", 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == [] and got(df.filter("vec_id = 0")) == []


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(0, [1e30], 1, "x", 0), (1, [1.0], 2, "x", 0)], SCHEMA)
    with pytest.raises(OverflowError):
        hard_negatives.mine(df, F.col("id") % 50 == 0)


def test_oracle(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = __spark_entry__.queries()["op11_hard_negatives"](spark, SF)
    want = db.execute(f"SELECT {', '.join(found.columns)} FROM ({__spark_entry__.oracle_sql()['op11_hard_negatives']})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)
