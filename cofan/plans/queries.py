"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables through ``cofan.sources.testdata``
and returns a lazy DataFrame whose column names equal its SQL twin's in
``cofan.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofan import functions as TF
from cofan.functions.titles import search_title as _search_title
from cofan.operators import aggregates as A
from cofan.operators import als as ALSOPS
from cofan.operators import catalog as C
from cofan.operators import compare as CMP
from cofan.operators import corating
from cofan.operators import ids as IDS
from cofan.operators import quality as Q
from cofan.operators import splits as SP
from cofan.operators.cards import result_cards
from cofan.operators.matching import match_seeds, seed_status
from cofan.plans import batch_run
from cofan.plans import oracle as O
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA
from cofan.session import checkpoint_dir
from cofan.sources import csv as CSV
from cofan.sources import files as FILES
from cofan.sources import parquet as PARQUET
from cofan.sources import persist_tables, testdata, unpersist_tables
from cofan.sources import sinks as SINKS

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# ---- C1: similar-item recommendation ------------------------------------------

SEED_EXACT = "small ring"
SEED_SUBSTRING = "ring"
SEED_FULL_TITLE = "small ring (1961)"


def _similar(seed: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ratings, movies = testdata.load(spark, sf_dir)
        # Registered queries are total: no match gives an empty result (as in
        # SQL) instead of the API's eager ValueError check.
        return corating.recommend_similar(ratings, movies, seed, top_n=10, check=False)

    return run


register("similar_items_exact", O.corated_sql(O.seed_sources_sql(SEED_EXACT), 10))(_similar(SEED_EXACT))
register("similar_items_substring", O.corated_sql(O.seed_sources_sql(SEED_SUBSTRING), 10))(
    _similar(SEED_SUBSTRING)
)
register("similar_items_full_title", O.corated_sql(O.seed_sources_sql(SEED_FULL_TITLE), 10))(
    _similar(SEED_FULL_TITLE)
)


# ---- C1 batch, C2 variants ------------------------------------------------------


BATCH_TOP_N = 10


def batch_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds derived from the data: every distinct part name and every last word."""
    p = testdata.table(spark, sf_dir, "part")
    q = p.select(F.col("p_name").alias("query")).unionByName(
        p.select(F.regexp_extract("p_name", r"(\S+)$", 1).alias("query"))
    )
    return q.filter(F.col("query").isNotNull()).distinct().select(F.col("query").alias("query_id"), "query")


@register(
    "similar_items_batch",
    O.with_views(
        f"""
SELECT query_id, rank, movieId, title, genres, fan_rating_count FROM (
  SELECT c.query_id, c.movieId, m.title, m.genres, c.fan_rating_count,
         row_number() OVER (PARTITION BY c.query_id
                            ORDER BY c.fan_rating_count DESC, m.title ASC NULLS FIRST, c.movieId ASC NULLS FIRST) AS rank
  FROM (
    SELECT f.query_id, l.movieId, count(*) AS fan_rating_count
    FROM (SELECT DISTINCT s.query_id, l.userId FROM src s JOIN likes l ON l.movieId = s.movieId) f
    JOIN likes l ON l.userId = f.userId
    GROUP BY f.query_id, l.movieId
  ) c
  JOIN movies m ON m.movieId = c.movieId
  WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.query_id = c.query_id AND s.movieId = c.movieId)
) WHERE rank <= {BATCH_TOP_N}""",
        O.seeds_sql(),
    ),
)
def similar_items_batch(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    out = corating.recommend_batch(ratings, movies, batch_seeds(spark, sf_dir), top_n=BATCH_TOP_N)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "similar_items_seed_status",
    O.with_views(
        """
SELECT s.query_id, s.query,
       CASE WHEN length(q.q) = 0 THEN 'blank'
            WHEN t.tier IS NULL THEN 'no_match'
            WHEN t.tier = 1 THEN 'exact' ELSE 'substring' END AS status,
       coalesce(t.n, 0) AS source_count
FROM (SELECT query AS query_id, query FROM seeds) s
JOIN sq q ON q.query_id = s.query_id
LEFT JOIN (SELECT query_id, min(tier) AS tier, count(*) AS n FROM src GROUP BY query_id) t
  ON t.query_id = s.query_id""",
        O.seeds_sql(),
    ),
)
def similar_items_seed_status(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    seeds = batch_seeds(spark, sf_dir)
    return seed_status(seeds, match_seeds(movies, seeds))


# Source sets derived from the data: the most-rated movie, and the ten most-rated
# movies (ties by id).
TOP_SOURCES = "sources AS (SELECT movieId FROM (SELECT movieId, count(*) AS n FROM ratings GROUP BY movieId) ORDER BY n DESC, movieId ASC LIMIT {n})"


def _top_sources(spark, sf_dir, n):
    ratings, movies = testdata.load(spark, sf_dir)
    return ratings, movies, A.most_rated_ids(ratings, n)


@register("corated_by_id", O.corated_sql(TOP_SOURCES.format(n=1), None))
def corated_by_id(spark, sf_dir):
    ratings, movies, src = _top_sources(spark, sf_dir, 1)
    return corating.recommend_for_ids(ratings, movies, src, top_n=None)


@register("corated_by_id_list", O.corated_sql(TOP_SOURCES.format(n=10), 20))
def corated_by_id_list(spark, sf_dir):
    ratings, movies, src = _top_sources(spark, sf_dir, 10)
    return corating.recommend_for_ids(ratings, movies, src, top_n=20)


@register("corated_keep_source", O.corated_sql(TOP_SOURCES.format(n=1), None, exclude=False))
def corated_keep_source(spark, sf_dir):
    ratings, movies, src = _top_sources(spark, sf_dir, 1)
    return corating.recommend_for_ids(ratings, movies, src, top_n=None, exclude_sources=False)


@register(
    "popular_candidates",
    O.with_views(
        """
SELECT c.movieId, m.title, m.genres, c.fan_rating_count, n.num_ratings
FROM (
  SELECT movieId, count(*) AS fan_rating_count FROM likes
  WHERE userId IN (SELECT userId FROM likes WHERE movieId IN (SELECT movieId FROM sources))
    AND movieId NOT IN (SELECT movieId FROM sources)
  GROUP BY movieId
) c
JOIN movies m ON m.movieId = c.movieId
JOIN (SELECT movieId, count(*) AS num_ratings FROM ratings GROUP BY movieId) n ON n.movieId = c.movieId
WHERE n.num_ratings >= 20""",
        TOP_SOURCES.format(n=10),
    ),
)
def popular_candidates(spark, sf_dir):
    ratings, movies, src = _top_sources(spark, sf_dir, 10)
    recs = corating.recommend_for_ids(ratings, movies, src, top_n=None)
    return A.popular_only(recs, ratings, 20)


@register(
    "genre_summary",
    O.with_views(
        """
SELECT count(*) AS result_rows, CAST(sum(fan_rating_count) AS BIGINT) AS total_signals,
       (SELECT count(DISTINCT g) FROM (SELECT unnest(string_split(genres, '|')) AS g FROM r
        WHERE genres IS NOT NULL) WHERE g <> '(no genres listed)') AS genres_represented
FROM r""",
        "r AS (" + O.corated_sql(O.seed_sources_sql(SEED_EXACT), 10).replace("WITH ", "SELECT * FROM (WITH ", 1) + "))",
    ),
)
def genre_summary(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return corating.result_summary(corating.recommend_similar(ratings, movies, SEED_EXACT, top_n=10, check=False))


# ---- C3, C4, aggregates -----------------------------------------------------------


@register(
    "top_movies",
    O.with_views(
        """
SELECT s.movieId, m.title, m.genres, s.rating_count, s.average_rating
FROM (SELECT movieId, count(*) AS rating_count, round(avg(rating), 3) AS average_rating
      FROM ratings GROUP BY movieId) s
JOIN movies m ON m.movieId = s.movieId
ORDER BY rating_count DESC, average_rating DESC NULLS LAST, m.title ASC NULLS FIRST, s.movieId ASC NULLS FIRST
LIMIT 100"""
    ),
)
def top_movies(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return A.top_movies(ratings, movies, 100)


@register(
    "most_rated_top10",
    O.with_views(
        """
SELECT s.movieId, m.title, m.genres, s.rating_count
FROM (SELECT movieId, count(*) AS rating_count FROM ratings GROUP BY movieId) s
JOIN movies m ON m.movieId = s.movieId
ORDER BY rating_count DESC, m.title ASC NULLS FIRST, s.movieId ASC NULLS FIRST
LIMIT 10"""
    ),
)
def most_rated_top10(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return A.most_rated(ratings, movies, 10)


@register("mean_rating_by_movie", O.with_views("SELECT movieId, avg(rating) AS mean_rating FROM ratings GROUP BY movieId"))
def mean_rating_by_movie(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return A.mean_rating_by_movie(ratings)


@register(
    "mean_rating_group_count",
    O.with_views("SELECT count(*) AS movie_groups FROM (SELECT movieId, avg(rating) FROM ratings GROUP BY movieId)"),
)
def mean_rating_group_count(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return A.mean_rating_group_count(ratings)


@register(
    "dataset_overview",
    O.with_views(
        """
SELECT count(*) AS rating_rows, count(DISTINCT userId) AS unique_users,
       count(DISTINCT movieId) AS unique_movies_rated, avg(rating) AS average_rating,
       min(rating) AS minimum_rating, max(rating) AS maximum_rating
FROM ratings"""
    ),
)
def dataset_overview(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return A.overview(ratings)


@register(
    "rating_time_range",
    O.with_views(
        """
SELECT min("timestamp") AS earliest_epoch, max("timestamp") AS latest_epoch,
       strftime(make_timestamp(min("timestamp") * 1000000), '%Y-%m-%d %H:%M:%S') AS earliest_utc,
       strftime(make_timestamp(max("timestamp") * 1000000), '%Y-%m-%d %H:%M:%S') AS latest_utc
FROM ratings"""
    ),
)
def rating_time_range(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return A.time_range(ratings)


@register(
    "rating_distribution",
    O.with_views("SELECT rating, count(*) AS rating_count FROM ratings GROUP BY rating ORDER BY rating"),
)
def rating_distribution(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return A.rating_distribution(ratings)


@register(
    "row_counts",
    O.with_views(
        """
SELECT 'ratings' AS table_name, count(*) AS row_count FROM ratings
UNION ALL SELECT 'movies' AS table_name, count(*) AS row_count FROM movies"""
    ),
)
def row_counts(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return A.row_counts(ratings, movies)


ARTICLE_ROWS = [
    (-1, "Matrix, The (1999)", "Action|Sci-Fi"),
    (-2, "Beautiful Mind, A (2001)  ", "Drama"),
    (-3, "X, the (2000)", None),
    (-4, "Nothing", "(no genres listed)"),
    (-5, "Apple, An (1980)", "Comedy|Drama"),
]


def _article_sql() -> str:
    vals = ", ".join(
        "({}, '{}', {})".format(i, t.replace("'", "''"), "NULL" if g is None else "'" + g + "'")
        for i, t, g in ARTICLE_ROWS
    )
    return f"lit(movieId, title, genres) AS (VALUES {vals})"


def _with_articles(spark, movies: DataFrame) -> DataFrame:
    """``movies`` and the literal rows, which nobody rated."""
    return movies.unionByName(spark.createDataFrame(ARTICLE_ROWS, "movieId bigint, title string, genres string"))


# ---- quality ------------------------------------------------------------------------


def _null_sql(table: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count_if(\"{c}\" IS NULL) AS BIGINT) AS null_count FROM {table}"
        for c in cols
    ]
    return "\nUNION ALL ".join(parts)


@register(
    "null_profile",
    O.with_views(
        _null_sql("dirty_ratings", RATINGS_SCHEMA.fieldNames()) + "\nUNION ALL " + _null_sql("dirty_movies", MOVIES_SCHEMA.fieldNames()),
        O.DIRTY,
    ),
)
def null_profile(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return Q.null_profile(testdata.dirty_ratings(ratings), "dirty_ratings").unionByName(
        Q.null_profile(testdata.dirty_movies(movies), "dirty_movies")
    )


@register(
    "key_uniqueness",
    O.with_views(
        """
SELECT 'dirty_movies' AS table_name, CAST(sum(n) AS BIGINT) AS row_count,
       CAST(count_if(movieId IS NOT NULL) AS BIGINT) AS distinct_keys,
       CAST(count_if(movieId IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_keys,
       CAST(coalesce(sum(CASE WHEN movieId IS NULL THEN n END), 0) AS BIGINT) AS null_keys
FROM (SELECT movieId, count(*) AS n FROM dirty_movies GROUP BY movieId)""",
        O.DIRTY,
    ),
)
def key_uniqueness(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    return Q.key_uniqueness(testdata.dirty_movies(movies), "movieId", "dirty_movies")


def _cast_sql(table: str, schema) -> str:
    duck = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    parts = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        v = f'CAST("{f.name}" AS VARCHAR)'
        parts.append(
            f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{t}' AS target_type, "
            f"CAST(count_if({v} IS NOT NULL) AS BIGINT) AS non_null, "
            f"CAST(count_if({v} IS NOT NULL AND TRY_CAST({v} AS {duck[t]}) IS NULL) AS BIGINT) AS failures FROM {table}"
        )
    return "\nUNION ALL ".join(parts)


def _dirty_snapshot(spark, sf_dir) -> str:
    """The dirty adapter tables as a CSV snapshot of shards."""
    out = scratch_dir(spark, "dirty")
    ratings, movies = testdata.load(spark, sf_dir)
    SINKS.write_csv(testdata.dirty_ratings(ratings), FILES.join(out, "ratings.csv"))
    # Reordered header: must still bind by name.
    SINKS.write_csv(testdata.dirty_movies(movies).select("title", "genres", "movieId"), FILES.join(out, "movies.csv"))
    return out


def _held(df: DataFrame, path: str) -> DataFrame:
    """A small result kept by a reliable checkpoint; the written tables below ``path``,
    which it was read from, are deleted."""
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    SINKS.delete(df.sparkSession, path)
    return out


@register(
    "cast_failures",
    O.with_views(_cast_sql("dirty_ratings", RATINGS_SCHEMA) + "\nUNION ALL " + _cast_sql("dirty_movies", MOVIES_SCHEMA), O.DIRTY),
)
def cast_failures(spark, sf_dir):
    """Text cells of a CSV snapshot that do not cast, per column."""
    snap = _dirty_snapshot(spark, sf_dir)
    found = [
        Q.cast_failures(CSV.read_as_text(spark, FILES.join(snap, f"{t}.csv")), schema, f"dirty_{t}")
        for t, schema in (("ratings", RATINGS_SCHEMA), ("movies", MOVIES_SCHEMA))
    ]
    return _held(found[0].unionByName(found[1]), snap)


def _bad_sql(table: str, schema) -> str:
    duck = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    return " OR ".join(f'("{f.name}" IS NOT NULL AND TRY_CAST("{f.name}" AS {duck[f.dataType.simpleString()]}) IS NULL)' for f in schema.fields)


def _line_sql(*names: str) -> str:
    return " || ',' || ".join(f"coalesce(CAST(\"{n}\" AS VARCHAR), '')" for n in names)


@register(
    "malformed_records",
    O.with_views(
        f"""
SELECT 'ratings' AS table_name, count(*) AS record_count, CAST(count_if(bad) AS BIGINT) AS malformed,
       min(CASE WHEN bad THEN line END) AS example
FROM (SELECT {_bad_sql("ratings", RATINGS_SCHEMA)} AS bad, {_line_sql(*RATINGS_SCHEMA.fieldNames())} AS line FROM dirty_ratings)
UNION ALL
SELECT 'movies', count(*), CAST(0 AS BIGINT), NULL FROM dirty_movies""",
        O.DIRTY,
    ),
)
def malformed_records(spark, sf_dir):
    """Records of a CSV snapshot that do not fit the contract, traced to their files
    and summed per table."""
    snap = _dirty_snapshot(spark, sf_dir)
    per_file = [
        Q.malformed_records(CSV.with_lineage(spark, FILES.join(snap, f"{t}.csv"), schema), t)
        for t, schema in (("ratings", RATINGS_SCHEMA), ("movies", MOVIES_SCHEMA))
    ]
    out = per_file[0].unionByName(per_file[1]).filter("file IS NOT NULL").groupBy("table_name").agg(
        F.sum("record_count").alias("record_count"), F.sum("malformed").alias("malformed"), F.min("example").alias("example"))
    return _held(out, snap)


@register(
    "unrated_movies",
    O.with_views(
        """
SELECT movieId, title, genres FROM (SELECT movieId, title, genres FROM movies UNION ALL SELECT * FROM lit) m
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.movieId = m.movieId)""",
        _article_sql(),
    ),
)
def unrated_movies(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return A.unrated_movies(_with_articles(spark, movies), ratings)


# ---- title functions, catalogue -----------------------------------------------------

@register(
    "title_functions",
    O.with_views(
        r"""
SELECT movieId, title, search_title, release_year, clean_title,
       CASE WHEN release_year IS NULL THEN clean_title
            ELSE clean_title || ' (' || release_year || ')' END AS display_title,
       genres_display
FROM (
  SELECT movieId, title,
         lower(regexp_replace(title, '\s*\(\d{4}\)$', '')) AS search_title,
         nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') AS release_year,
         regexp_replace(regexp_replace(regexp_replace(title, '\((\d{4})\)\s*$', ''), '^\s+|\s+$', '', 'g'),
                        '^(.+), (The|A|An)$', '\2 \1') AS clean_title,
         replace(genres, '|', ' · ') AS genres_display
  FROM (SELECT movieId, title, genres FROM movies UNION ALL SELECT * FROM lit)
)""",
        _article_sql(),
    ),
)
def title_functions(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    t = F.col("title")
    return _with_articles(spark, movies).select(
        "movieId",
        "title",
        _search_title(t).alias("search_title"),
        TF.release_year(t).alias("release_year"),
        TF.clean_title(t).alias("clean_title"),
        TF.display_title(t).alias("display_title"),
        TF.genre_display("genres").alias("genres_display"),
    )


@register("title_listing", O.with_views("SELECT title FROM movies ORDER BY title ASC NULLS FIRST"))
def title_listing(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    return C.title_listing(movies)


LOOKUP_TITLE = "small ring (1961)"


@register(
    "title_lookup",
    O.with_views(
        f"SELECT movieId, title, genres FROM movies WHERE title = '{LOOKUP_TITLE}' "
        "ORDER BY movieId ASC NULLS FIRST LIMIT 1"
    ),
)
def title_lookup(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    return C.title_lookup(movies, LOOKUP_TITLE)


LOOKUP_ID = 1


@register(
    "movie_rating_count",
    O.with_views(
        f"SELECT CAST({LOOKUP_ID} AS BIGINT) AS movieId, count(*) AS rating_count FROM ratings WHERE movieId = {LOOKUP_ID}"
    ),
)
def movie_rating_count(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return C.movie_rating_count(ratings, LOOKUP_ID)


def _panel_sql(title: str) -> str:
    return O.with_views(
        r"""
SELECT p.movieId,
       CASE WHEN yr IS NULL THEN clean ELSE clean || ' (' || yr || ')' END AS display_title,
       coalesce(nullif(yr, ''), 'Year unavailable') AS year_text,
       replace(coalesce(nullif(p.genres, ''), 'Genres unavailable'), '|', ' · ') AS genres_text,
       coalesce(c.n, 0) AS rating_count,
       format('{:,}', coalesce(c.n, 0)) || ' ratings' AS rating_text,
       'https://www.themoviedb.org/search/movie?query=' || replace(url_encode(clean), '%20', '+') AS search_link
FROM (
  SELECT movieId, title, genres,
         nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') AS yr,
         regexp_replace(regexp_replace(regexp_replace(title, '\((\d{4})\)\s*$', ''), '^\s+|\s+$', '', 'g'),
                        '^(.+), (The|A|An)$', '\2 \1') AS clean
  FROM (SELECT movieId, title, genres FROM movies UNION ALL SELECT * FROM lit) WHERE title = '"""
        + title
        + r"""' ORDER BY movieId ASC NULLS FIRST LIMIT 1
) p
LEFT JOIN (SELECT movieId, count(*) AS n FROM ratings GROUP BY movieId) c ON c.movieId = p.movieId""",
        _article_sql(),
    )


ARTICLE_TITLE = "Matrix, The (1999)"


def _panel(title: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ratings, movies = testdata.load(spark, sf_dir)
        return C.movie_panel(_with_articles(spark, movies), ratings, title)

    return run


register("selected_movie_panel", _panel_sql(LOOKUP_TITLE))(_panel(LOOKUP_TITLE))
register("article_movie_panel", _panel_sql(ARTICLE_TITLE))(_panel(ARTICLE_TITLE))


LABELS = C.POPULAR_LABELS + ["Small Ring", "red widget", "BLUE BOLT", "Nothing Here"]


@register(
    "popular_label_lookup",
    O.with_views(
        r"""
SELECT l.label, b.full_title
FROM lab l
LEFT JOIN (
  SELECT k, min(title) AS full_title FROM (
    SELECT lower(regexp_replace(regexp_replace(regexp_replace(title, '\((\d{4})\)\s*$', ''),
                 '^\s+|\s+$', '', 'g'), '^(.+), (The|A|An)$', '\2 \1')) AS k, title
    FROM movies) GROUP BY k
) b ON b.k = lower(l.label)""",
        "lab(label) AS (VALUES " + ", ".join("('" + x + "')" for x in LABELS) + ")",
    ),
)
def popular_label_lookup(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    labels = spark.createDataFrame([(x,) for x in LABELS], "label string")
    return C.resolve_labels(movies, labels)


@register(
    "title_search",
    O.with_views("SELECT movieId, title FROM movies WHERE contains(title, 'ring')"),
)
def title_search(spark, sf_dir):
    _, movies = testdata.load(spark, sf_dir)
    return movies.filter(F.col("title").contains("ring")).select("movieId", "title")


_BEST_MATCH = """
SELECT query_title, release_year, attempt, position, title, release_date, poster_path,
       CASE tier WHEN 1 THEN 'title_and_year' WHEN 2 THEN 'title' WHEN 3 THEN 'year' ELSE 'fallback' END AS match_tier,
       'https://image.tmdb.org/t/p/w500' || poster_path AS image_url
FROM (
  SELECT *, row_number() OVER (PARTITION BY query_title, release_year
                               ORDER BY (tier = 4), attempt, tier, position) AS rn
  FROM (
    SELECT *, CASE WHEN th AND yh THEN 1 WHEN th THEN 2
                   WHEN release_year IS NOT NULL AND yh THEN 3 ELSE 4 END AS tier
    FROM (
      SELECT *,
        (lower(coalesce(title, '')) = lower(query_title)
         OR lower(coalesce(original_title, '')) = lower(query_title)) AS th,
        (CASE WHEN length(nullif(release_date, '')) >= 4 THEN substr(release_date, 1, 4) END)
          IS NOT DISTINCT FROM release_year AS yh
      FROM candidates
      WHERE poster_path IS NOT NULL AND poster_path <> ''
    )
  )
) WHERE rn = 1"""


@register("catalog_best_match", O.with_views(_BEST_MATCH, O.CANDIDATES))
def catalog_best_match(spark, sf_dir):
    cands = testdata.catalogue_candidates(testdata.table(spark, sf_dir, "part"))
    return C.best_matches(cands)


# ---- sample vs full, splits ---------------------------------------------------------

SAMPLE_ROWS = 20000


def _overview_sql(src: str) -> str:
    return (
        f"SELECT count(*)::DOUBLE AS rating_rows, count(DISTINCT userId)::DOUBLE AS unique_users, "
        f"count(DISTINCT movieId)::DOUBLE AS unique_movies_rated, avg(rating)::DOUBLE AS average_rating, "
        f"min(rating)::DOUBLE AS minimum_rating, max(rating)::DOUBLE AS maximum_rating FROM {src}"
    )


def _top10_sql(src: str) -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY c.n DESC, m.title ASC NULLS FIRST, c.movieId ASC NULLS FIRST) AS rank, "
        f"c.movieId FROM (SELECT movieId, count(*) AS n FROM {src} GROUP BY movieId) c "
        f"JOIN movies m ON m.movieId = c.movieId "
        f"ORDER BY c.n DESC, m.title ASC NULLS FIRST, c.movieId ASC NULLS FIRST LIMIT 10"
    )


@register(
    "sample_vs_full",
    O.with_views(
        f"""
SELECT s.metric, s.v AS sample_value, f.v AS full_value, s.v - f.v AS difference
FROM (UNPIVOT ({_overview_sql('smp')}) ON COLUMNS(*) INTO NAME metric VALUE v) s
JOIN (UNPIVOT ({_overview_sql('ratings')}) ON COLUMNS(*) INTO NAME metric VALUE v) f ON s.metric = f.metric
UNION ALL
SELECT 'top10_same_rank' AS metric, cnt AS sample_value, 10.0 AS full_value, cnt - 10.0 AS difference
FROM (SELECT count_if(a.movieId = b.movieId)::DOUBLE AS cnt
      FROM ({_top10_sql('smp')}) a FULL JOIN ({_top10_sql('ratings')}) b ON a.rank = b.rank)""",
        f"""smp AS (SELECT * FROM ratings
  ORDER BY userId ASC NULLS FIRST, movieId ASC NULLS FIRST, "timestamp" ASC NULLS FIRST, rating ASC NULLS FIRST
  LIMIT {SAMPLE_ROWS})""",
    ),
)
def sample_vs_full(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    return CMP.sample_vs_full(ratings, movies, SAMPLE_ROWS)


def _bucket_sql(word: int) -> str:
    key = """CAST(userId AS VARCHAR) || ':' || CAST(movieId AS VARCHAR) || ':' || CAST("timestamp" AS VARCHAR)"""
    return f"(('0x' || substr(md5({key}), {1 + 8 * word}, 8))::UBIGINT % 100)"


@register(
    "hash_split_counts",
    O.with_views(
        f"""
SELECT count(*) AS sample_rows, CAST(count_if(inner_b < 80) AS BIGINT) AS train_rows,
       CAST(count_if(inner_b >= 80) AS BIGINT) AS test_rows
FROM (SELECT {_bucket_sql(0)} AS b, {_bucket_sql(1)} AS inner_b FROM ratings) WHERE b < 5"""
    ),
)
def hash_split_counts(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return SP.hash_split_counts(ratings, 5, 80)


# ---- rows-only queries (no SQL twin) ------------------------------------------------


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    return FILES.join(checkpoint_dir(spark), "cofan-scratch", f"{tag}-{uuid.uuid4().hex[:12]}")


def _cards_sql() -> str:
    clean = r"""regexp_replace(regexp_replace(regexp_replace(title, '\((\d{4})\)\s*$', ''), '^\s+|\s+$', '', 'g'), '^(.+), (The|A|An)$', '\2 \1')"""
    year = r"""nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '')"""
    body = f"""
SELECT CAST(row_number() OVER (ORDER BY r.fan_rating_count DESC, r.title ASC NULLS FIRST,
                                        r.movieId ASC NULLS FIRST) AS INTEGER) AS rank,
       r.movieId,
       CASE WHEN r.yr IS NULL THEN r.clean ELSE r.clean || ' (' || r.yr || ')' END AS display_title,
       replace(coalesce(nullif(r.genres, ''), 'Genres unavailable'), '|', ' · ') AS genres_text,
       format('{{:,}}', r.fan_rating_count) || ' similar-fan ratings' AS count_text,
       'https://www.themoviedb.org/search/movie?query=' || replace(url_encode(r.clean), '%20', '+') AS search_link,
       coalesce(p.image_url, 'placeholder:no-poster') AS image_url
FROM (SELECT *, {clean} AS clean, {year} AS yr FROM recs0) r
LEFT JOIN picks p ON p.query_title = r.clean AND p.release_year IS NOT DISTINCT FROM r.yr"""
    recs = O.corated_sql(O.seed_sources_sql(SEED_EXACT), 10)
    return O.with_views(
        body, f"recs0 AS (SELECT * FROM ({recs})),\npicks AS (SELECT * FROM ({O.with_views(_BEST_MATCH, O.CARD_CANDIDATES)}))"
    )


@register("recommendation_cards", _cards_sql())
def recommendation_cards(spark, sf_dir):
    ratings, movies = testdata.load(spark, sf_dir)
    recs = corating.recommend_similar(ratings, movies, SEED_EXACT, top_n=10, check=False)
    picks = C.best_matches(testdata.card_candidates(testdata.table(spark, sf_dir, "part")))
    return result_cards(recs, picks)


def _als(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    model, _, test = ALSOPS.experiment(ratings)
    return model, test


@register("als_predictions")
def als_predictions(spark, sf_dir):
    model, test = _als(spark, sf_dir)
    return ALSOPS.predict(model, test)


@register("als_rmse")
def als_rmse(spark, sf_dir):
    model, test = _als(spark, sf_dir)
    return ALSOPS.rmse_frame(ALSOPS.predict(model, test))


@register("als_top10_titles")
def als_top10_titles(spark, sf_dir):
    model, _ = _als(spark, sf_dir)
    _, movies = testdata.load(spark, sf_dir)
    return ALSOPS.with_titles(ALSOPS.recommend_all(model, 10), movies)


@register("als_popular_recs")
def als_popular_recs(spark, sf_dir):
    model, _ = _als(spark, sf_dir)
    ratings, movies = testdata.load(spark, sf_dir)
    return ALSOPS.popular_recs(ALSOPS.recommend_all(model, 10), movies, ratings, 20)


WIDE = 1 << 40  # beyond 32 bits


@register(
    "dense_user_index",
    O.with_views(f"""
SELECT userId + {WIDE} AS "userId", CAST(row_number() OVER (ORDER BY userId) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT userId FROM ratings)"""),
)
def dense_user_index(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    return IDS.dense_index(ratings.withColumn("userId", F.col("userId") + WIDE), "userId", "idx")


@register(
    "als_coverage",
    O.with_views(f"""
SELECT count(DISTINCT userId) AS users, count(DISTINCT userId) AS users_with_rows,
       least(10, count(DISTINCT movieId)) AS least_rows, least(10, count(DISTINCT movieId)) AS most_rows,
       min(userId) + {WIDE} AS first_user, max(userId) + {WIDE} AS last_user, CAST(0 AS BIGINT) AS unknown_movies
FROM ratings"""),
)
def als_coverage(spark, sf_dir):
    """Ids beyond 32 bits through a fit on all ratings and back: every user gets ten
    different known movies."""
    ratings, movies = testdata.load(spark, sf_dir)
    wide = ratings.select((F.col("userId") + WIDE).alias("userId"), (F.col("movieId") + WIDE).alias("movieId"), "rating")
    indexed, users, items = IDS.index_ratings(wide)
    recs = IDS.restore(ALSOPS.recommend_all(ALSOPS.fit(indexed), 10), users, items)
    known = movies.select((F.col("movieId") + WIDE).alias("movieId"), F.lit(True).alias("known"))
    per_user = recs.join(known, "movieId", "left").groupBy("userId").agg(
        F.count_distinct("movieId").alias("n"), F.count_if(F.col("known").isNull()).alias("unknown"))
    return users.join(per_user, "userId", "left").agg(
        F.count(F.lit(1)).alias("users"), F.count("n").alias("users_with_rows"), F.min("n").alias("least_rows"),
        F.max("n").alias("most_rows"), F.min("userId").alias("first_user"), F.max("userId").alias("last_user"),
        F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown_movies"),
    )


@register(
    "als_facts",
    O.with_views(
        """
SELECT * FROM (
  SELECT 'predicted' AS fact, CAST(count(*) AS DOUBLE) AS value FROM test
  WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)
  UNION ALL SELECT 'outside_clamp', 0.0
  UNION ALL SELECT 'rmse_as_evaluator', 1.0
  UNION ALL SELECT 'recommended', CAST(10 * count(DISTINCT userId) AS DOUBLE) FROM train
  UNION ALL SELECT 'untitled', 0.0
  UNION ALL SELECT 'popular_and_rare', CAST(10 * count(DISTINCT userId) AS DOUBLE) FROM train
  UNION ALL SELECT 'wrong_counts', 0.0
  UNION ALL SELECT 'subset_users', CAST(least(5, count(DISTINCT userId)) AS DOUBLE) FROM train
)""",
        f"""train AS (SELECT * FROM ratings WHERE {_bucket_sql(1)} < 80),
test AS (SELECT * FROM ratings WHERE {_bucket_sql(1)} >= 80)""",
    ),
)
def als_facts(spark, sf_dir):
    """What holds for any model fitted on the hash split: the test rows it predicts, the
    clamp, RMSE by two ways, recommendations per user, titles and the popularity filter."""
    ratings, movies = testdata.load(spark, sf_dir)
    train, test = SP.hash_split(ratings, 80)
    model = ALSOPS.fit(train)
    pred = ALSOPS.predict(model, test).checkpoint(eager=True)
    flat = ALSOPS.recommend_all(model, 10).checkpoint(eager=True)
    titled, popular = ALSOPS.with_titles(flat, movies), ALSOPS.popular_recs(flat, movies, ratings, 20)
    counts = A.rating_counts(ratings, "n")
    rare = flat.join(counts, "movieId").filter("n < 20")
    users = train.select("userId").distinct().orderBy("userId").limit(5)
    clamped = F.col("prediction_clamped")
    fact = lambda name, df, value: df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("fact"), "value")
    n = F.count(F.lit(1))
    rows = [
        fact("predicted", ALSOPS.rmse_frame(pred), F.max("n")),
        fact("outside_clamp", pred, F.count_if(~clamped.between(0.5, 5.0))),
        fact("rmse_as_evaluator", ALSOPS.rmse_frame(pred), F.count_if(F.abs(F.col("rmse") - ALSOPS.rmse(pred)) < 1e-9)),
        fact("recommended", flat, n),
        fact("untitled", titled, F.count_if(F.col("title").isNull())),
        fact("popular_and_rare", popular.select("userId").unionAll(rare.select("userId")), n),
        fact("wrong_counts", popular.join(counts, "movieId"), F.count_if(F.col("num_ratings") != F.col("n"))),
        fact("subset_users", ALSOPS.recommend_for_users(model, users, 3), F.count_distinct("userId")),
    ]
    return reduce(DataFrame.unionByName, rows)


@register("random_sample_split")
def random_sample_split(spark, sf_dir):
    ratings, _ = testdata.load(spark, sf_dir)
    sample = SP.sample(ratings, 0.05, 42)
    train, test = SP.random_split(sample, (0.8, 0.2), 42)
    return train.select(F.lit("train").alias("part"), "*").unionByName(test.select(F.lit("test").alias("part"), "*"))


def _write_snapshot(spark, sf_dir) -> str:
    """The adapter tables written as a CSV snapshot (one folder of shards per table)."""
    out = scratch_dir(spark, "snapshot")
    ratings, movies = testdata.load(spark, sf_dir)
    SINKS.write_csv(ratings, FILES.join(out, "ratings.csv"))
    # Reordered header: must still bind by name.
    SINKS.write_csv(movies.select("title", "genres", "movieId"), FILES.join(out, "movies.csv"))
    return out


#: ``top_movies`` with ids at the CSV contract's int type.
_INT_TOP = SQL["top_movies"].replace("SELECT s.movieId, m.title", "SELECT CAST(s.movieId AS INTEGER) AS movieId, m.title", 1)


@register("csv_round_trip", _INT_TOP)
def csv_round_trip(spark, sf_dir):
    snap = _write_snapshot(spark, sf_dir)
    ratings, movies = CSV.load(spark, snap)
    return _held(A.top_movies(ratings, movies, 100), snap)


@register("parquet_round_trip", _INT_TOP)
def parquet_round_trip(spark, sf_dir):
    """Top movies from a Parquet zone at the contract's types, its tables persisted
    while the counts are taken."""
    zone = scratch_dir(spark, "zone")
    for name, df in zip(("ratings", "movies"), testdata.load(spark, sf_dir)):
        SINKS.write_parquet(df, FILES.join(zone, name))
    kept = persist_tables(*PARQUET.load(spark, zone, cast=True))
    out = _held(A.top_movies(*kept, 100), zone)
    unpersist_tables(*kept)
    return out


@register(
    "inferred_types",
    O.with_views("""
SELECT * FROM (VALUES ('movies', 'title', 'string'), ('movies', 'genres', 'string'), ('movies', 'movieId', 'int'),
  ('ratings', 'userId', 'int'), ('ratings', 'movieId', 'int'), ('ratings', 'rating', 'double'), ('ratings', 'timestamp', 'int'))
  t(table_name, column_name, inferred), (SELECT count(*) AS rated_rows FROM ratings)"""),
)
def inferred_types(spark, sf_dir):
    """Types that an exploratory read infers from the whole CSV snapshot."""
    snap = _write_snapshot(spark, sf_dir)
    tables = {t: CSV.read_inferred(spark, FILES.join(snap, f"{t}.csv")) for t in ("ratings", "movies")}
    types = [(t, c, kind) for t, df in tables.items() for c, kind in df.dtypes]
    rated = tables["ratings"].agg(F.count(F.lit(1)).alias("rated_rows"))
    out = spark.createDataFrame(types, "table_name string, column_name string, inferred string").withColumn("rated_rows", rated.scalar())
    return _held(out, snap)


@register(
    "input_contract",
    O.with_views(
        f"""
SELECT 'ratings.csv' AS table_name, true AS headers_complete, count(*) AS record_count,
       CAST(count_if({_bad_sql("ratings", RATINGS_SCHEMA)}) AS BIGINT) AS malformed,
       CAST(count_if("userId" IS NULL OR "movieId" IS NULL) AS BIGINT) AS without_key FROM dirty_ratings
UNION ALL
SELECT 'movies.csv', true, count(*), CAST(0 AS BIGINT), CAST(count_if(movieId IS NULL) AS BIGINT) FROM dirty_movies""",
        O.DIRTY,
    ),
)
def input_contract(spark, sf_dir):
    """Every file's header and every record of a CSV snapshot against the contract:
    records, malformed ones, and ones whose text has no key."""
    snap = _dirty_snapshot(spark, sf_dir)
    report = FILES.header_report(FILES.headers(spark, snap))
    complete = report.groupBy("table_name").agg(F.every(F.size("missing") == 0).alias("headers_complete"))
    parts = []
    for name, schema, keys in (("ratings", RATINGS_SCHEMA, ("userId", "movieId")), ("movies", MOVIES_SCHEMA, ("movieId",))):
        path = FILES.join(snap, f"{name}.csv")
        bad = Q.malformed_records(CSV.with_lineage(spark, path, schema), name).agg(
            F.sum("record_count").alias("record_count"), F.sum("malformed").alias("malformed"))
        text = CSV.read_as_text(spark, path)
        without = text.agg(F.count_if(reduce(Column.__or__, [F.col(k).isNull() for k in keys])).alias("n"))
        parts.append(bad.select(F.lit(f"{name}.csv").alias("table_name"), "*", without.scalar().alias("without_key")))
    return _held(complete.join(parts[0].unionByName(parts[1]), "table_name"), snap)


def _fingerprint_sql(table: str, columns: list[str]) -> str:
    cell = lambda c: f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    word = lambda k: f"CAST(sum(('0x' || substr(h, {1 + 8 * k}, 8))::UBIGINT) AS BIGINT)"
    text = " || ".join(map(cell, columns))
    return f"SELECT '{table}' AS table_name, count(*) AS row_count, {word(0)} AS hash_a, {word(1)} AS hash_b FROM (SELECT md5({text}) AS h FROM {table})"


#: Columns of the raw tables that the logical tables are made of.
_SOURCE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"], "orders": ["o_orderkey", "o_custkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
}


@register("snapshot_fingerprint", "\nUNION ALL ".join(_fingerprint_sql(t, c) for t, c in _SOURCE_COLUMNS.items()))
def snapshot_fingerprint(spark, sf_dir):
    """Fingerprints of the contents of the tables that the library's inputs come from."""
    rows = [FILES.content_fingerprint(testdata.table(spark, sf_dir, t).select(*c), t) for t, c in _SOURCE_COLUMNS.items()]
    return reduce(DataFrame.unionByName, rows)


def _batch_run(spark, sf_dir) -> tuple[str, str]:
    """(snapshot, output) of a batch run over the sharded CSV snapshot."""
    snap, out = _write_snapshot(spark, sf_dir), scratch_dir(spark, "run")
    batch_run.run(spark, snap, out, movie_title=SEED_EXACT, top_n=10, processed_top_n=100)
    return snap, out


@register(
    "batch_run_record",
    O.with_views(
        f"""
SELECT 'success' AS status, (SELECT count(*) FROM ratings) AS ratings, (SELECT count(*) FROM movies) AS movies,
       (SELECT count(*) FROM ({SQL['top_movies']})) AS processed_top_movies,
       (SELECT count(*) FROM ({SQL['similar_items_exact']})) AS sample_recommendations, true AS utc_times"""
    ),
)
def batch_run_record(spark, sf_dir):
    """The run record of a batch run, read back from its JSON lines."""
    snap, out = _batch_run(spark, sf_dir)
    iso = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?\+00:00$"
    times = F.col("completed_at").rlike(iso) & F.col("started_at").rlike(iso) & (F.col("started_at") <= F.col("completed_at"))
    counts = [F.col(f"row_counts.{c}").alias(c) for c in ("ratings", "movies", "processed_top_movies", "sample_recommendations")]
    got = _held(batch_run.read_run_records(spark, out).select("status", *counts, times.alias("utc_times")), snap)
    SINKS.delete(spark, out)
    return got


@register("batch_run_top_movies", SQL["top_movies"])
def batch_run_top_movies(spark, sf_dir):
    """The top movies that a batch run wrote, read back with their types."""
    snap, out = _batch_run(spark, sf_dir)
    top = spark.read.option("header", True).option("escape", '"').csv(FILES.join(out, batch_run.TOP), schema=(
        "movieId long, title string, genres string, rating_count long, average_rating double"))
    got = _held(top, snap)
    SINKS.delete(spark, out)
    return got


@register("similar_items_checked", SQL["similar_items_exact"])
def similar_items_checked(spark, sf_dir):
    """The recommendation with its check that some title matches."""
    ratings, movies = testdata.load(spark, sf_dir)
    return corating.recommend_similar(ratings, movies, SEED_EXACT, top_n=10, check=True)
