"""First-N by search over counts against a plain sort."""

import math
import random

import pytest

from cofan.operators import compare as CMP
from cofan.schemas import RATINGS_SCHEMA


def _key(row):
    last = lambda x: (1,) if x is None else (2, x) if not (isinstance(x, float) and math.isnan(x)) else (3,)
    return [last(row[k]) for k in (0, 1, 3, 2)]


def _check(spark, rows, ns):
    df = spark.createDataFrame(rows, RATINGS_SCHEMA).repartition(5)
    want = sorted(rows, key=_key)
    for n in ns:
        got = sorted((tuple(r) for r in CMP.first_rows(df, n).collect()), key=_key)
        assert [_key(r) for r in got] == [_key(r) for r in want[:n]], n
    return df


@pytest.fixture(autouse=True)
def small_bounds(monkeypatch):
    monkeypatch.setattr(CMP, "SORTED_ROWS", 7)
    monkeypatch.setattr(CMP, "BUCKETS", 4)


def test_far_off_and_hot_users(spark):
    rnd = random.Random(1)
    rows = [(5, rnd.randrange(3), float(rnd.randrange(4)), rnd.randrange(6)) for _ in range(120)]
    rows += [(rnd.randrange(12), rnd.randrange(9), rnd.choice([None, 1.5, float("nan")]), rnd.randrange(1 << 60)) for _ in range(60)]
    rows += [((1 << 31) - 1, 1, 2.0, 0), (-(1 << 31), 1, 2.0, 0), (None, 3, 1.0, 1), (None, None, None, None)]
    _check(spark, rows, [0, 1, 2, 3, 20, 77, 110, 150, 183, 184, 500])


def test_rows_all_alike_and_empty(spark):
    rows = [(1, 2, 3.0, 4)] * 40 + [(0, 0, 0.0, 0)]
    _check(spark, rows, [1, 5, 41])
    assert _check(spark, [], [3]).count() == 0


def test_wide_range_of_longs(spark):
    lo, hi = -(1 << 63), (1 << 63) - 1
    rows = [(1, 1, 1.0, lo + k) for k in range(20)] + [(1, 1, 1.0, hi - k) for k in range(20)] + [(1, 1, 1.0, 0)]
    _check(spark, rows, [3, 20, 21, 33])


def test_only_a_bounded_bucket_is_sorted(spark):
    rows = [(9, 1, 1.0, k) for k in range(200)] + [(10**9, 1, 1.0, 0)]
    df = spark.createDataFrame(rows, RATINGS_SCHEMA)
    before, inside, left, one = CMP._cut(df.groupBy("userId").agg(CMP.F.count("*").alias("_n")), "userId", 150)
    assert one and left == 150 and df.filter(before).count() == 0 and df.filter(inside).count() == 200
    before, inside, left, one = CMP._cut(df.filter(inside).groupBy("timestamp").agg(CMP.F.count("*").alias("_n")), "timestamp", 150)
    assert df.filter(inside).count() <= CMP.SORTED_ROWS + 1 and left <= CMP.SORTED_ROWS
