"""DuckDB SQL twins of the registered queries.

Each string runs on the raw test tables (pre-registered views) through the
same logical-table definitions as ``cofan.sources.testdata``.  Orderings
spell out null placement to match Spark (ASC = NULLS FIRST, DESC = NULLS LAST)
and every ranking carries the ``movieId`` tie-break.
"""

from __future__ import annotations

VIEWS = """
ratings AS (
  SELECT o.o_custkey AS userId,
         l.l_partkey AS movieId,
         CAST(ceil(l.l_quantity / 5) / 2 AS DOUBLE) AS rating,
         CAST(epoch_ms(l.l_shipdate) // 1000 AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
movies AS (
  SELECT p_partkey AS movieId,
         p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' AS title,
         p_type || '|' || replace(p_brand, '#', '') AS genres
  FROM part
),
likes AS (SELECT userId, movieId FROM ratings WHERE rating >= 4.5)
"""


def with_views(body: str, extra: str = "") -> str:
    ctes = VIEWS.strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}\n"


def search_title_sql(col: str) -> str:
    return f"lower(regexp_replace({col}, '\\s*\\(\\d{{4}}\\)$', ''))"


def seed_sources_sql(seed: str) -> str:
    """``sources(movieId)`` for one literal seed: exact tier, else substring tier."""
    q = seed.strip().lower().replace("'", "''")
    return f"""
exact_src AS (SELECT movieId FROM movies WHERE {search_title_sql('title')} = '{q}'),
sources AS (
  SELECT movieId FROM exact_src
  UNION ALL
  SELECT movieId FROM movies
  WHERE contains(lower(title), '{q}') AND NOT EXISTS (SELECT 1 FROM exact_src)
)"""


def corated_sql(sources_cte: str, top_n: int | None, exclude: bool = True) -> str:
    excl = "AND movieId NOT IN (SELECT movieId FROM sources WHERE movieId IS NOT NULL)" if exclude else ""
    limit = f"LIMIT {int(top_n)}" if top_n is not None else ""
    return with_views(
        f"""
SELECT c.movieId, m.title, m.genres, c.fan_rating_count
FROM (
  SELECT movieId, count(*) AS fan_rating_count
  FROM likes
  WHERE userId IN (SELECT userId FROM likes WHERE movieId IN (SELECT movieId FROM sources))
    {excl}
  GROUP BY movieId
) c JOIN movies m ON c.movieId = m.movieId
ORDER BY c.fan_rating_count DESC, m.title ASC NULLS FIRST, c.movieId ASC NULLS FIRST
{limit}""",
        sources_cte,
    )


def seeds_sql() -> str:
    """Batch seeds derived from the data: every part name and every last word."""
    return r"""
seeds AS (
  SELECT DISTINCT query FROM (
    SELECT p_name AS query FROM part
    UNION ALL
    SELECT regexp_extract(p_name, '(\S+)$', 1) AS query FROM part
  )
),
sq AS (
  SELECT query AS query_id, lower(regexp_replace(query, '^\s+|\s+$', '', 'g')) AS q
  FROM seeds WHERE query IS NOT NULL
),
sq_nb AS (SELECT * FROM sq WHERE length(q) > 0),
mt AS (SELECT movieId, title, genres, lower(regexp_replace(title, '\s*\(\d{4}\)$', '')) AS st FROM movies),
allm AS (
  SELECT s.query_id, m.movieId, 1 AS tier FROM sq_nb s JOIN mt m ON m.st = s.q
  UNION ALL
  SELECT s.query_id, m.movieId, 2 AS tier FROM sq_nb s JOIN mt m ON contains(lower(m.title), s.q)
),
src AS (
  SELECT a.query_id, a.movieId, a.tier FROM allm a
  JOIN (SELECT query_id, min(tier) AS tier FROM allm GROUP BY query_id) b
    ON a.query_id = b.query_id AND a.tier = b.tier
)"""


CANDIDATES = r"""
prow AS (
  SELECT p_partkey AS k, p_name, p_type, p_size,
         CAST(1950 + p_size AS VARCHAR) AS own_year,
         regexp_extract(p_name, '^(\S+)', 1) AS first_word
  FROM part
),
by_name AS (SELECT p_name AS query_title, * FROM prow),
by_word AS (SELECT first_word AS query_title, * FROM prow),
name_year AS (SELECT query_title, arg_min(own_year, k) AS release_year FROM by_name GROUP BY query_title),
word_year AS (
  SELECT query_title,
         CASE WHEN length(query_title) % 2 = 0 THEN arg_min(own_year, k) END AS release_year
  FROM by_word GROUP BY query_title
),
cands AS (
  SELECT b.*, y.release_year FROM by_name b JOIN name_year y USING (query_title)
  UNION ALL
  SELECT b.*, y.release_year FROM by_word b JOIN word_year y USING (query_title)
),
shaped AS (
  SELECT query_title, release_year, k, CAST(k AS INTEGER) AS position,
         CASE WHEN k % 6 = 0 THEN upper(p_name) WHEN k % 6 = 1 THEN p_name
              ELSE p_name || ' (sequel)' END AS title,
         CASE WHEN k % 4 = 0 THEN p_name ELSE p_type END AS original_title,
         CASE WHEN k % 7 = 0 THEN ''
              ELSE CAST(CASE WHEN k % 2 = 0 THEN 1950 + p_size ELSE 1951 + p_size END AS VARCHAR) || '-01-01'
         END AS release_date,
         CASE WHEN k % 5 = 0 THEN NULL WHEN k % 10 = 3 THEN ''
              ELSE '/p' || CAST(k AS VARCHAR) || '.jpg' END AS poster_path
  FROM cands
),
candidates AS (
  SELECT query_title, release_year, 1 AS attempt, position, title, original_title, release_date, poster_path
  FROM shaped
  UNION ALL
  SELECT query_title, release_year, 2 AS attempt, position, title, original_title, release_date, poster_path
  FROM shaped WHERE release_year IS NOT NULL
)"""

#: The candidates of the cards: the first attempt lists five keys of nine.
CARD_CANDIDATES = CANDIDATES.replace("FROM shaped\n", "FROM shaped WHERE k % 9 < 5\n")

DIRTY = """
dirty_ratings AS (
  SELECT CASE WHEN userId % 97 = 0 THEN 'u' ELSE '' END || CAST(userId AS VARCHAR) AS "userId",
         CASE WHEN movieId % 89 <> 0 THEN CAST(movieId AS VARCHAR) END AS "movieId",
         CASE WHEN userId % 53 = 0 THEN 'n/a' ELSE CAST(rating AS VARCHAR) END AS "rating",
         CAST("timestamp" AS VARCHAR) || CASE WHEN movieId % 71 = 0 THEN 's' ELSE '' END AS "timestamp"
  FROM ratings
),
dirty_movies AS (
  SELECT CASE WHEN movieId % 101 <> 0 THEN movieId END AS movieId, CASE WHEN movieId % 17 <> 0 THEN title END AS title,
         CASE WHEN movieId % 19 <> 0 THEN genres END AS genres
  FROM movies, range(CASE WHEN movieId % 13 = 0 THEN 2 ELSE 1 END)
)"""
