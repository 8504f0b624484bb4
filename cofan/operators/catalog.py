"""Title catalogue: listings, lookups, label resolution and best-match selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofan.functions.formats import (
    GENRES_UNAVAILABLE,
    YEAR_UNAVAILABLE,
    image_url,
    or_default,
    search_link,
    thousands,
)
from cofan.functions.genres import genre_display
from cofan.functions.titles import casefold, clean_title, display_title, release_year, text_or_empty, year_of_date

# ---- fixed values -------------------------------------------------------------
POPULAR_LABELS = ["Inception", "The Matrix", "Interstellar", "The Dark Knight", "Toy Story"]
# --------------------------------------------------------------------------------


def title_listing(movies: DataFrame) -> DataFrame:
    """All titles in ascending order (range-partitioned sort, no driver list)."""
    return movies.select("title").orderBy(F.col("title").asc_nulls_first())


def title_lookup(movies: DataFrame, title: str) -> DataFrame:
    """Metadata row of one exact title (lowest id when the title repeats)."""
    return (
        movies.filter(F.col("title") == F.lit(title))
        .select("movieId", "title", "genres")
        .orderBy(F.col("movieId").asc_nulls_first())
        .limit(1)
    )


def movie_rating_count(ratings: DataFrame, movie_id: int) -> DataFrame:
    """``(movieId, rating_count)`` for one movie; the id filter reaches the scan."""
    return ratings.filter(F.col("movieId") == F.lit(movie_id)).agg(F.count(F.lit(1)).alias("rating_count")).select(
        F.lit(movie_id).cast("bigint").alias("movieId"), "rating_count"
    )


def movie_panel(movies: DataFrame, ratings: DataFrame, title: str) -> DataFrame:
    """Detail fields of one selected title: display title, year (or a default),
    formatted genres (or a default), rating count and search link.

    The title lookup is bounded to one row, so the ratings are reduced by a semi
    join against it (a one-row broadcast) before counting.
    """
    picked = title_lookup(movies, title)
    counts = (
        ratings.select("movieId")
        .join(F.broadcast(picked.select("movieId")), "movieId", "left_semi")
        .groupBy("movieId")
        .agg(F.count(F.lit(1)).alias("rating_count"))
    )
    t = F.col("title")
    return picked.join(counts, "movieId", "left").select(
        "movieId",
        display_title(t).alias("display_title"),
        or_default(release_year(t), YEAR_UNAVAILABLE).alias("year_text"),
        genre_display(or_default("genres", GENRES_UNAVAILABLE)).alias("genres_text"),
        F.coalesce(F.col("rating_count"), F.lit(0)).alias("rating_count"),
        F.concat(thousands(F.coalesce(F.col("rating_count"), F.lit(0))), F.lit(" ratings")).alias("rating_text"),
        search_link(t).alias("search_link"),
    )


def resolve_labels(movies: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Label -> first full title (in title order) whose clean title equals it, case-insensitively.

    Labels without a match keep a NULL ``full_title``.
    """
    lab = labels.select(F.col(label_col).alias("label"), casefold(F.col(label_col)).alias("k"))
    keyed = movies.select(casefold(clean_title(F.col("title"))).alias("k"), "title")
    # Only titles whose key is some label's key are aggregated.
    best = keyed.join(lab.select("k"), "k", "left_semi").groupBy("k").agg(F.min("title").alias("full_title"))
    return lab.join(best, "k", "left").select("label", "full_title")


# ---- best-match selection over search candidates --------------------------------

TIER_NAMES = {1: "title_and_year", 2: "title", 3: "year", 4: "fallback"}


def best_matches(candidates: DataFrame) -> DataFrame:
    """One pick per ``(query_title, release_year)`` from a search-candidate table.

    Candidates need an image path (NULL and empty count as missing).  Within
    the first attempt, then the second: tier 1 = title (or original title)
    equals the query case-insensitively **and** the result year equals the
    query year (both missing counts as equal); tier 2 = title only; tier 3 =
    year only, when the query has a year; lowest position first.  If no attempt
    has a tiered hit, the first candidate overall is the fallback.

    Implemented as a grouped ``min`` over a struct whose leading fields are the
    sort keys, so a query with a very long candidate list is reduced by partial
    aggregation before any shuffle.
    """
    q = casefold(F.col("query_title"))
    title_hit = (casefold(text_or_empty("title")) == q) | (casefold(text_or_empty("original_title")) == q)
    year_hit = year_of_date(F.nullif(F.col("release_date"), F.lit(""))).eqNullSafe(F.col("release_year"))
    tier = (
        F.when(title_hit & year_hit, F.lit(1))
        .when(title_hit, F.lit(2))
        .when(F.col("release_year").isNotNull() & year_hit, F.lit(3))
        .otherwise(F.lit(4))
    )
    usable = candidates.filter(F.col("poster_path").isNotNull() & (F.col("poster_path") != ""))
    keyed = usable.select(
        "query_title",
        "release_year",
        F.struct(
            (tier == 4).alias("is_fallback"),
            F.col("attempt"),
            tier.alias("tier"),
            F.col("position"),
            F.col("title"),
            F.col("release_date"),
            F.col("poster_path"),
        ).alias("k"),
    )
    picked = keyed.groupBy("query_title", "release_year").agg(F.min("k").alias("k"))
    tier_name = F.element_at(
        F.create_map(*[x for t, n in TIER_NAMES.items() for x in (F.lit(t), F.lit(n))]), F.col("k.tier")
    )
    return picked.select(
        "query_title",
        "release_year",
        F.col("k.attempt").alias("attempt"),
        F.col("k.position").alias("position"),
        F.col("k.title").alias("title"),
        F.col("k.release_date").alias("release_date"),
        F.col("k.poster_path").alias("poster_path"),
        tier_name.alias("match_tier"),
        image_url(F.col("k.poster_path")).alias("image_url"),
    )
