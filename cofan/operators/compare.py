"""Sample-versus-full comparison: the same metrics on a bounded first-N slice and
on the full table, their differences, and how many top-10 ranks agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofan.session import checkpoint_dir

METRICS = ["rating_rows", "unique_users", "unique_movies_rated", "average_rating", "minimum_rating", "maximum_rating"]
ORDER = ["userId", "movieId", "timestamp", "rating"]

# Equal-width buckets of one step of the search; their counts reach the driver.
BUCKETS = 1024
# A bucket of at most so many rows is sorted, a larger one is searched further.
SORTED_ROWS = 1 << 16


def _position(c: Column, lo, hi, kind: str) -> Column:
    """The bucket of a value between ``lo`` and ``hi``; -1 for NULL, ``BUCKETS`` for NaN."""
    if lo is None or lo == hi:
        at = F.lit(0)
    else:
        # Differences of integers are exact in decimals, whatever their range.
        x, low, high = (c, F.lit(lo), F.lit(hi)) if kind in ("double", "float") else (v.cast("decimal(38,0)") for v in (c, F.lit(lo), F.lit(hi)))
        share = (x - low).cast("double") / (high - low).cast("double")
        at = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    nan = F.isnan(c) if kind in ("double", "float") else F.lit(False)
    return F.when(c.isNull(), -1).when(nan, BUCKETS).otherwise(at)


def _cut(counts: DataFrame, col: str, n: int) -> tuple[Column, Column, int, bool] | None:
    """Where row ``n + 1`` lies in the order of ``col`` (NULLs first, NaN last), for a
    frame of values and their row counts ``_n``: the condition of the rows before its
    bucket, that of its bucket, the rows of the bucket to take, and whether the bucket
    holds one value only.  None when there are no more than ``n`` rows.

    Each step counts equal-width buckets between the least and the largest value that
    are left and goes on inside the bucket found, so an outlier costs one more step.
    """
    c, kind = F.col(col), dict(counts.dtypes)[col]
    plain = c.isNotNull() & ~F.isnan(c) if kind in ("double", "float") else c.isNotNull()
    lo, hi = counts.filter(plain).agg(F.min(c), F.max(c)).first()
    rows, left, first = counts, n, True
    while True:
        got = rows.groupBy(_position(c, lo, hi, kind).alias("b")).agg(F.sum("_n").alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).orderBy("b").collect()
        for r in got:
            if r["n"] > left:
                break
            left -= r["n"]
        else:
            return None
        if r["b"] < 0:
            return F.lit(False), c.isNull(), left, True
        if r["b"] == BUCKETS:
            return c.isNull() | ~F.isnan(c), F.isnan(c), left, True
        lo, hi = r["lo"], r["hi"]
        inside = (c >= F.lit(lo)) & (c <= F.lit(hi)) & plain
        if lo == hi or r["n"] <= SORTED_ROWS:
            return c.isNull() | ((c < F.lit(lo)) & plain), inside, left, lo == hi
        rows = rows.filter(inside)


def first_rows(ratings: DataFrame, n: int, order: list[str] | None = None, lead_counts: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows in the order of the numeric columns ``order`` (a file-order
    prefix is not defined for split, parallel reads; the order makes the slice
    reproducible).

    The place of row ``n`` is searched column by column with counts alone.  Rows before
    it are kept by plain filters, and only a bucket of at most ``SORTED_ROWS`` rows is
    sorted: a value that more rows share is searched by the next column among its rows.
    ``lead_counts`` holds the rows (``_n``) of each value of the first column, if the
    caller has them.
    """
    order = order or ORDER
    parts, rows, left = [], ratings, int(n)
    for k, col in enumerate(order):
        counts = lead_counts if k == 0 and lead_counts is not None else rows.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        found = _cut(counts, col, left)
        if found is None:
            return reduce(DataFrame.unionByName, [*parts, rows])
        before, inside, left, one_value = found
        parts.append(rows.filter(before))
        rows = rows.filter(inside)
        if left == 0:
            return reduce(DataFrame.unionByName, parts)
        if not one_value:
            keys = [F.col(c).asc_nulls_first() for c in order[k:]]
            return reduce(DataFrame.unionByName, [*parts, rows.orderBy(*keys).limit(left)])
    if set(order) >= set(ratings.columns):  # the rows left are all alike
        rows = rows.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(left)))).select(*ratings.columns)
    else:
        rows = rows.limit(left)
    return reduce(DataFrame.unionByName, [*parts, rows])


def per_movie(ratings: DataFrame) -> DataFrame:
    """One row per movie with the partial sums of all metrics."""
    return ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("n"), F.count("rating").alias("rated"), F.sum("rating").alias("s"),
        F.min("rating").alias("lo"), F.max("rating").alias("hi"),
    )


def _metrics(movies: DataFrame, users: DataFrame, side: str) -> DataFrame:
    """``(metric, side)`` from the per-movie and per-user rollups."""
    wide = movies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rating_rows"), F.count("movieId").alias("unique_movies_rated"),
        (F.sum("s") / F.nullif(F.sum("rated"), F.lit(0))).alias("average_rating"),
        F.min("lo").alias("minimum_rating"), F.max("hi").alias("maximum_rating"),
    ).withColumn("unique_users", users.agg(F.count("userId").alias("n")).scalar())
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(side)) for m in METRICS])
    return wide.select(F.explode(pairs).alias("s")).select("s.metric", f"s.{side}")


def _top10(counts: DataFrame, movies: DataFrame) -> DataFrame:
    order = [F.col("n").desc(), F.col("title").asc_nulls_first(), F.col("movieId").asc_nulls_first()]
    top = counts.select("movieId", "n").join(movies.select("movieId", "title"), "movieId").orderBy(*order).limit(10)
    # A window over the 10 limited rows only.
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "movieId")


def sample_vs_full(ratings: DataFrame, movies: DataFrame, n: int) -> DataFrame:
    """``(metric, sample_value, full_value, difference)``, plus ``top10_same_rank``.

    The ratings are read three times: rows per user (distinct users, and the search
    for the sample's end), the per-movie rollup (all other metrics and the top 10), and
    the sample itself, which is kept.
    """
    checkpoint_dir(ratings.sparkSession)
    users = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    rollup = per_movie(ratings).checkpoint(eager=True)
    sample = first_rows(ratings, n, lead_counts=users).checkpoint(eager=True)
    own = per_movie(sample)
    metrics = (
        _metrics(own, sample.select("userId").distinct(), "sample_value")
        .join(_metrics(rollup, users, "full_value"), "metric")
        .withColumn("difference", F.col("sample_value") - F.col("full_value"))
    )
    a, b = _top10(own, movies).alias("a"), _top10(rollup, movies).alias("b")
    same = a.join(b, F.col("a.rank") == F.col("b.rank"), "full").agg(
        F.count_if(F.col("a.movieId") == F.col("b.movieId")).cast("double").alias("v")
    )
    overlap = same.select(
        F.lit("top10_same_rank").alias("metric"),
        F.col("v").alias("sample_value"),
        F.lit(10.0).alias("full_value"),
        (F.col("v") - F.lit(10.0)).alias("difference"),
    )
    return metrics.unionByName(overlap)
