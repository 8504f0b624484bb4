"""Views of the two logical tables over the TPC-H-like test tables.

``ratings`` = ``lineitem`` joined to ``orders`` on the order key:
user = customer key, movie = part key, rating = ``ceil(quantity / 5) / 2``
(0.5 .. 5.0 in half steps), timestamp = Unix seconds of the ship date.
``movies`` = ``part``: title = ``name (1950 + size)``, genres = ``type|brand``.

The order-key join is the only shuffle the adapter adds; at cluster scale it is
a sort-merge join of two co-partitioned sides (or free when both tables are
bucketed by order key), and the size check for a broadcast is left to the
planner (``autoBroadcastJoinThreshold`` from statistics, then AQE at runtime).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_RELATIONS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``<sf_dir>/<name>.parquet``.

    The relation (file listing and footer schema) is resolved once per session
    and path and then reused, like a catalog table: building a query no longer
    re-lists files.  Nothing is cached; every action still scans the files.
    Call ``refresh`` after the files change.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _RELATIONS.get(key)
    if df is None:
        df = _RELATIONS[key] = spark.read.parquet(path)
    return df


def refresh(spark: SparkSession, sf_dir: str | None = None) -> None:
    """Forget resolved relations (all, or those under ``sf_dir``) and Spark's file listings."""
    for key in [k for k in _RELATIONS if sf_dir is None or k[1].startswith(sf_dir.rstrip("/") + "/")]:
        spark.catalog.refreshByPath(key[1])
        del _RELATIONS[key]


def ratings_view(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        F.unix_timestamp("l_shipdate").alias("timestamp"),
    )


def movies_view(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.concat(
            F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")
        ).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))).alias(
            "genres"
        ),
    )


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(ratings, movies)`` over the test tables in ``sf_dir``."""
    ratings = ratings_view(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
    movies = movies_view(table(spark, sf_dir, "part"))
    return ratings, movies


def dirty_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings as text with cells that do not fit the contract: every 97th user id and
    every 71st movie's timestamps are no numbers, every 53rd user's ratings neither, and
    every 89th movie id is missing."""
    u, m = F.col("userId"), F.col("movieId")
    return ratings.select(
        F.when(u % 97 == 0, F.concat(F.lit("u"), u.cast("string"))).otherwise(u.cast("string")).alias("userId"),
        F.when(m % 89 != 0, m.cast("string")).alias("movieId"),
        F.when(u % 53 == 0, "n/a").otherwise(F.col("rating").cast("string")).alias("rating"),
        F.when(m % 71 == 0, F.concat(F.col("timestamp").cast("string"), F.lit("s"))).otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
    )


def dirty_movies(movies: DataFrame) -> DataFrame:
    """Movies with every 101st id, 17th title and 19th genre list missing, and every
    13th row given twice."""
    m = F.col("movieId")
    rows = movies.select(
        F.when(m % 101 != 0, m).alias("movieId"), F.when(m % 17 != 0, F.col("title")).alias("title"),
        F.when(m % 19 != 0, F.col("genres")).alias("genres"), F.explode(F.sequence(F.lit(1), F.when(m % 13 == 0, 2).otherwise(1))),
    )
    return rows.select("movieId", "title", "genres")


def catalogue_candidates(part: DataFrame) -> DataFrame:
    """Search-candidate rows derived from ``part`` for the catalogue matcher.

    Two query families, both over every part row:

    * query = a part name; candidates = the parts with that name;
      query year = year of the lowest-keyed such part.
    * query = the first word of a name; candidates = the parts whose name starts
      with it; query year = as above, or NULL when the word has odd length.

    Per candidate (key k): title = upper-cased name (k % 6 = 0), the name
    (k % 6 = 1) or ``name (sequel)``; original title = the name when k % 4 = 0,
    else the type; release date = empty (k % 7 = 0), ``(1950+size)-01-01`` for
    even k, ``(1951+size)-01-01`` for odd k; image path NULL (k % 5 = 0), empty
    (k % 10 = 3) or ``/p<k>.jpg``.  Attempt 1 lists every candidate at
    position k; attempt 2 repeats them when the query has a year.
    """
    own_year = (F.lit(1950) + F.col("p_size")).cast("string")
    first_word = F.regexp_extract(F.col("p_name"), r"^(\S+)", 1)
    rows = part.select(
        F.col("p_partkey").alias("k"),
        F.col("p_name"),
        F.col("p_type"),
        F.col("p_size"),
        own_year.alias("own_year"),
        first_word.alias("first_word"),
    )
    by_name = rows.select(F.col("p_name").alias("query_title"), "*")
    by_word = rows.select(F.col("first_word").alias("query_title"), "*")
    name_year = by_name.groupBy("query_title").agg(F.min_by("own_year", "k").alias("release_year"))
    word_year = by_word.groupBy("query_title").agg(
        F.when(F.length("query_title") % 2 == 0, F.min_by("own_year", "k")).alias("release_year")
    )
    cands = by_name.join(name_year, "query_title").unionByName(by_word.join(word_year, "query_title"))
    k = F.col("k")
    date_year = F.when(k % 2 == 0, F.lit(1950) + F.col("p_size")).otherwise(F.lit(1951) + F.col("p_size"))
    shaped = cands.select(
        "query_title",
        "release_year",
        k.cast("int").alias("position"),
        F.when(k % 6 == 0, F.upper("p_name"))
        .when(k % 6 == 1, F.col("p_name"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" (sequel)")))
        .alias("title"),
        F.when(k % 4 == 0, F.col("p_name")).otherwise(F.col("p_type")).alias("original_title"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(date_year.cast("string"), F.lit("-01-01"))).alias(
            "release_date"
        ),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 3, F.lit(""))
        .otherwise(F.concat(F.lit("/p"), k.cast("string"), F.lit(".jpg")))
        .alias("poster_path"),
    )
    attempt1 = shaped.withColumn("attempt", F.lit(1))
    attempt2 = shaped.filter(F.col("release_year").isNotNull()).withColumn("attempt", F.lit(2))
    return attempt1.unionByName(attempt2).select(
        "query_title", "release_year", "attempt", "position", "title", "original_title", "release_date", "poster_path"
    )


def card_candidates(part: DataFrame) -> DataFrame:
    """``catalogue_candidates`` whose first attempt lists positions with k % 9 < 5, so
    that the second one finds more."""
    return catalogue_candidates(part).filter((F.col("attempt") == 2) | (F.col("position") % 9 < 5))
