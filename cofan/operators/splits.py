"""Sampling and train/test splits.

``sample`` / ``randomSplit`` are Spark's seeded Bernoulli samplers: their rows
depend on the partition layout even with a fixed seed.  The key-hash variants
put each row in a bucket ``0..99`` from an MD5 of its key columns, so the
split is layout-independent, reproducible in SQL, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_KEY = ("userId", "movieId", "timestamp")


def sample(ratings: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    return ratings.sample(fraction=fraction, seed=seed)


def random_split(ratings: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    return ratings.randomSplit(list(weights), seed=seed)


def hash_bucket(key_cols=DEFAULT_KEY, buckets: int = 100, word: int = 0):
    """``0..buckets-1`` from 32 bits of MD5 over ``a:b:c`` (``word`` 0..3 picks which 32 bits)."""
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols])
    hex8 = F.substring(F.md5(key), 1 + 8 * int(word), 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % buckets).cast("int")


def hash_sample(ratings: DataFrame, percent: int = 5, key_cols=DEFAULT_KEY) -> DataFrame:
    return ratings.filter(hash_bucket(key_cols) < int(percent))


def hash_split(ratings: DataFrame, train_percent: int = 80, key_cols=DEFAULT_KEY) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key_cols, word=1)
    return ratings.filter(b < int(train_percent)), ratings.filter(b >= int(train_percent))


def hash_split_counts(ratings: DataFrame, sample_percent: int = 5, train_percent: int = 80,
                      key_cols=DEFAULT_KEY) -> DataFrame:
    """Row counts of the sample and of its train / test parts, in one pass."""
    # Train/test inside the sample uses the next 32 bits of the digest, so the
    # split is independent of the sample bucket.
    sampled = ratings.select(hash_bucket(key_cols).alias("b"), hash_bucket(key_cols, word=1).alias("inner"))
    inner = F.col("inner")
    s = sampled.filter(F.col("b") < int(sample_percent))
    return s.agg(
        F.count(F.lit(1)).alias("sample_rows"),
        F.count_if(inner < int(train_percent)).alias("train_rows"),
        F.count_if(inner >= int(train_percent)).alias("test_rows"),
    )
