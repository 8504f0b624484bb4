"""Co-rating ("fans of X also liked Y") recommendation.

Plan for one seed (all lazy, no driver round trip for ids):

    likes   = ratings[rating >= min_rating](userId, movieId)   -- filter at the scan
    sources = match(movies, seed)                                -- small: ids of one title
    fans    = likes ⋉ sources  on movieId  -> userId             -- existence only
    counts  = likes ⋉ fans     on userId   -> count per movieId  -- partial aggregation
    result  = (counts ▷ sources) ⋈ movies -> top-k (count desc, title, movieId)

``▷`` is an anti join (sources are excluded) and ``⋉`` a semi join (a fan is
counted once however many sources they liked, so the fan rows need no
distinct).  The fan semi-join is the one wide shuffle of ``likes`` (by userId)
unless the cohort is small enough for the planner to broadcast; a user holding
a large share of all ratings makes one skewed partition on the likes side,
which AQE's skew-join handling splits (semi joins split their left side; this
needs both join inputs to be plain shuffles, see ``tests/test_skew.py``).
Counting happens before the titles join, so the dimension join sees one row
per candidate movie, and the top-k is a ``TakeOrderedAndProject``
(per-partition top-k, no global sort).

The batch form takes a seed table and keeps ``query_id`` through every step:
source pairs checkpointed and size-checked, distinct ``(query_id, userId)``
fans joined to likes on userId (an inner join, so the fans must be distinct),
counts per ``(query_id, movieId)``, and a per-seed ``row_number`` window
limited to top-k (planned with a partial group limit before the window's
shuffle).  Users with more than ``HEAVY_LIKES`` likes are found first (a count with
partial aggregation), and only their rows are salted on both sides of that join, so
that a hot user spreads over the cluster with or without AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofan.operators import joins
from cofan.operators.matching import match_seed, match_seeds, seed_candidates
from cofan.session import checkpoint_dir

DEFAULT_MIN_RATING = 4.5
DEFAULT_TOP_N = 10
# A user with more likes than this is dealt over SALTS parts of the batch join.
HEAVY_LIKES, SALTS = 1 << 18, 64

RESULT_COLUMNS = ["movieId", "title", "genres", "fan_rating_count"]


def likes(ratings: DataFrame, min_rating: float = DEFAULT_MIN_RATING) -> DataFrame:
    """Ratings at or above the threshold (inclusive), ids only."""
    return ratings.filter(F.col("rating") >= F.lit(float(min_rating))).select("userId", "movieId")


def ranking_order(count_col: str = "fan_rating_count"):
    """Count descending, then title, then id: a total order, so the cut is deterministic."""
    return [F.col(count_col).desc(), F.col("title").asc_nulls_first(), F.col("movieId").asc_nulls_first()]


def fan_cohort(ratings: DataFrame, sources: DataFrame, min_rating: float = DEFAULT_MIN_RATING) -> DataFrame:
    """Distinct users who rated any source movie at or above the threshold."""
    return likes(ratings, min_rating).join(sources.select("movieId"), "movieId", "left_semi").select("userId").distinct()


def salted_semi_join(left: DataFrame, keys: DataFrame, key: str, salt_buckets: int, salt_from: str) -> DataFrame:
    """``left ⋉ keys`` on ``key`` with the join key salted into ``salt_buckets``.

    Each left row takes a salt from a hash of ``salt_from`` (deterministic, so a
    recomputed task makes the same choice) and the key side is replicated once
    per salt.  A hot key's left rows then spread over ``salt_buckets`` join
    partitions whatever the AQE setting; the result equals the plain semi join
    because the test is existence only.
    """
    salt = F.pmod(F.xxhash64(F.col(salt_from)), F.lit(int(salt_buckets))).cast("int")
    salted_left = left.withColumn("_salt", salt)
    salts = F.explode(F.sequence(F.lit(0), F.lit(int(salt_buckets) - 1))).alias("_salt")
    salted_keys = keys.select(key).distinct().select(key, salts)
    return salted_left.join(salted_keys, [key, "_salt"], "left_semi").drop("_salt")


def corated_counts(ratings: DataFrame, sources: DataFrame, min_rating: float = DEFAULT_MIN_RATING,
                   exclude_sources: bool = True, salt_buckets: int | None = None) -> DataFrame:
    """``(movieId, fan_rating_count)``: liked-rating rows by fans of the sources.

    Counts rating rows, not users (a fan who rated a movie twice counts twice).
    ``salt_buckets`` salts the fan semi join explicitly (for clusters without
    AQE's skew split); by default AQE splits a hot user's partition.
    """
    src = sources.select("movieId")
    liked = likes(ratings, min_rating)
    # Fan rows are not de-duplicated: the semi join only tests existence, and
    # leaving the right side a plain hash shuffle on userId keeps this join
    # eligible for AQE's skew split (a hot user's likes are divided across
    # tasks); a distinct there would feed the join from an aggregate instead.
    fans = liked.join(src, "movieId", "left_semi").select("userId")
    if salt_buckets and salt_buckets > 1:
        fan_likes = salted_semi_join(liked, fans, "userId", salt_buckets, "movieId")
    else:
        fan_likes = liked.join(fans, "userId", "left_semi")
    counts = fan_likes.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("fan_rating_count")
    )
    if exclude_sources:
        counts = counts.join(src, "movieId", "left_anti")
    return counts


def with_titles(counts: DataFrame, movies: DataFrame) -> DataFrame:
    """Inner join to the dimension (ids without metadata are dropped)."""
    return counts.join(movies.select("movieId", "title", "genres"), "movieId").select(*RESULT_COLUMNS)


def top_k(df: DataFrame, top_n: int, count_col: str = "fan_rating_count") -> DataFrame:
    return df.orderBy(*ranking_order(count_col)).limit(int(top_n))


def recommend_similar(ratings: DataFrame, movies: DataFrame, seed: str, top_n: int = DEFAULT_TOP_N,
                      min_rating: float = DEFAULT_MIN_RATING, check: bool = True,
                      salt_buckets: int | None = None) -> DataFrame:
    """Top-``top_n`` movies liked by users who liked the movie(s) matching ``seed``.

    Raises ``ValueError`` for a blank seed, and (when ``check``) when no title
    matches; the check is one small job over the movies dimension.
    """
    if seed is None or not seed.strip():
        raise ValueError("a blank title names no movie")
    # Some title matches iff some candidate of either tier exists: a one-stage
    # filtered scan of the dimension that stops at the first hit.
    if check and seed_candidates(movies, seed).isEmpty():
        raise ValueError(f"no title equals or contains {seed!r}")
    sources = match_seed(movies, seed)
    return top_k(with_titles(corated_counts(ratings, sources, min_rating, salt_buckets=salt_buckets), movies), top_n)


def recommend_for_ids(ratings: DataFrame, movies: DataFrame, source_ids: DataFrame,
                      top_n: int | None = DEFAULT_TOP_N, min_rating: float = DEFAULT_MIN_RATING,
                      exclude_sources: bool = True) -> DataFrame:
    """Co-rating ranking for a given set of source ids (a one-column DataFrame)."""
    ranked = with_titles(corated_counts(ratings, source_ids, min_rating, exclude_sources), movies)
    return top_k(ranked, top_n) if top_n is not None else ranked


def ids_frame(spark, ids, dtype: str = "bigint") -> DataFrame:
    """A one-column ``movieId`` frame from a list of ids."""
    return spark.createDataFrame([(int(i),) for i in ids], f"movieId {dtype}")


def heavy_users(liked: DataFrame, at_least: int | None = None) -> DataFrame:
    """``userId`` of the users with more than ``at_least`` likes: at most
    rows / ``at_least`` of them."""
    bound = HEAVY_LIKES if at_least is None else int(at_least)
    return liked.groupBy("userId").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound).select("userId")


def fan_pairs(liked: DataFrame, fans: DataFrame, heavy: DataFrame, salts: int) -> DataFrame:
    """``liked ⋈ fans`` on userId; the likes of ``heavy`` users are dealt into ``salts``
    parts by movie, and their fan rows go to each part."""
    mark = heavy.select("userId", F.lit(True).alias("_heavy"))
    deal = F.when(F.col("_heavy"), F.pmod(F.xxhash64("movieId"), F.lit(int(salts))).cast("int")).otherwise(F.lit(0))
    every = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(int(salts) - 1))).otherwise(F.array(F.lit(0)))
    left = liked.join(mark, "userId", "left").select("userId", "movieId", deal.alias("_salt"))
    right = fans.join(mark, "userId", "left").select("query_id", "userId", F.explode(every).alias("_salt"))
    return left.join(right, ["userId", "_salt"]).select("query_id", "userId", "movieId")


def recommend_batch(ratings: DataFrame, movies: DataFrame, seeds: DataFrame, top_n: int = DEFAULT_TOP_N,
                    min_rating: float = DEFAULT_MIN_RATING, query_col: str = "query",
                    salt_buckets: int | None = None) -> DataFrame:
    """Top-``top_n`` per seed for a seed table ``(query_id, <query_col>)``.

    Output ``(query_id, rank, movieId, title, genres, fan_rating_count)``;
    seeds that are blank or match nothing contribute no rows (see
    ``matching.seed_status`` for a per-seed status).  Equal to running
    ``recommend_similar`` once per seed.  ``salt_buckets`` is the number of parts a
    heavy user is dealt into.
    """
    # Source pairs are materialised once in the shared checkpoint folder: the
    # matching sub-plan is not recomputed for the exclusion join, and the size
    # check below reads the written pairs, not a planner estimate (which the
    # exploded n-gram index makes too low).
    checkpoint_dir(seeds.sparkSession)
    sources = match_seeds(movies, seeds, query_col).select("query_id", "movieId").checkpoint(eager=True)
    src = joins.side(sources, joins.at_most(sources))
    liked = likes(ratings, min_rating)
    fans = liked.join(src, "movieId").select("query_id", "userId").distinct()
    heavy = heavy_users(liked).checkpoint(eager=True)
    pairs = liked.join(fans, "userId")
    if not heavy.isEmpty():
        pairs = fan_pairs(liked, fans, joins.side(heavy, joins.at_most(heavy)), salt_buckets or SALTS)
    counts = (
        pairs
        .groupBy("query_id", "movieId")
        .agg(F.count(F.lit(1)).alias("fan_rating_count"))
        .join(src, ["query_id", "movieId"], "left_anti")
    )
    # Movies without metadata drop out before the cut.  The first cut compares numbers
    # only and keeps every tie of the last count; titles join the few rows it leaves.
    best = top_counts(counts.join(movies.select("movieId"), "movieId", "left_semi"), top_n)
    ranked = best.join(movies.select("movieId", "title", "genres"), "movieId")
    w = Window.partitionBy("query_id").orderBy(*ranking_order())
    return (
        ranked.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= int(top_n))
        .select("query_id", "rank", *RESULT_COLUMNS)
    )


def top_counts(counts: DataFrame, top_n: int) -> DataFrame:
    """The rows of each query whose count is among its ``top_n`` largest, ties included."""
    w = Window.partitionBy("query_id").orderBy(F.col("fan_rating_count").desc())
    return counts.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= int(top_n)).drop("_r")


def result_summary(recs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, total fan-rating signals and distinct genres of a result (per ``by`` group).

    One aggregate over ``posexplode_outer`` of the genre list: the first
    position (or a NULL genre list) stands for the result row itself, so rows
    and signals are counted once per row while genres are counted over all
    positions (the sentinel excluded; an empty string counts as a genre).
    """
    from cofan.functions.genres import NO_GENRES_SENTINEL, genre_list

    by = by or []
    exploded = recs.select(
        *by, "fan_rating_count", F.posexplode_outer(genre_list("genres")).alias("pos", "genre")
    )
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    return exploded.groupBy(*by).agg(
        F.count_if(first).alias("result_rows"),
        F.sum(F.when(first, F.col("fan_rating_count"))).alias("total_signals"),
        F.count_distinct(F.when(F.col("genre") != F.lit(NO_GENRES_SENTINEL), F.col("genre"))).alias(
            "genres_represented"
        ),
    )
