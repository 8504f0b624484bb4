"""Seed-title -> source-movie matching.

Two tiers, per seed: **exact** (search title equals the normalised seed) and,
only when a seed has no exact hit, **substring** (lower-cased full title
contains the seed literally, no wildcards).  All ids of the winning tier are
sources.

* One seed: two literal filters over ``movies`` and a global ``min(tier)``
  used as a scalar subquery (a one-row aggregate, no join).
* Many seeds (a DataFrame): the exact tier is an equi-join on the search title.  The
  substring tier, for seeds without an exact hit, is an equi-join on a gram (``GRAM``
  characters, fewer for a shorter seed) followed by the ``contains`` test, so no
  nested-loop or cartesian plan is needed however large the seed table is.  A title
  that contains a seed contains each of its grams, so one gram a seed suffices:
  titles per gram are counted first, for the grams of the seeds only, and each seed
  probes with its rarest one.  A seed such as "the hobbit" never meets every title
  with "the"; a seed without a gram in any title goes at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofan.functions.titles import normalise_query, search_title
from cofan.operators import joins
from cofan.session import checkpoint_dir

GRAM = 3
EXACT, SUBSTRING = 1, 2


def seed_candidates(movies: DataFrame, seed: str) -> DataFrame:
    """``(movieId, tier)`` for every title hit by either tier (before tier selection)."""
    q = normalise_query(F.lit(seed))  # a constant, folded once; the batch form uses the same expression
    title = F.col("title")
    cand = movies.select(
        "movieId",
        F.when(search_title(title) == q, F.lit(EXACT))
        .when(F.lower(title).contains(q), F.lit(SUBSTRING))
        .alias("tier"),
    ).filter(F.col("tier").isNotNull())
    return cand


def match_seed(movies: DataFrame, seed: str) -> DataFrame:
    """``(movieId, tier)`` of every source movie for one seed string."""
    cand = seed_candidates(movies, seed)
    # The winning tier is a one-row aggregate used as a scalar subquery.
    return cand.filter(F.col("tier") == cand.agg(F.min("tier")).scalar()).select("movieId", "tier")


def grams(text, length) -> Column:
    """Every substring of ``length`` characters, in order (repeats included)."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - length + 1, F.lit(1)))
    return F.filter(F.transform(starts, lambda i: F.substring(text, i, length)), lambda g: F.length(g) == length)


def title_grams(movies: DataFrame, lengths: list[int]) -> DataFrame:
    """``(movieId, lower_title, gram)``: the substrings of these lengths, a row per
    place, built with ``explode(sequence)`` and ``substring`` so that the step stays in
    generated code.  A gram at several places of a title gives several rows."""
    lt = F.lower(F.col("title"))
    starts = movies.select("movieId", lt.alias("lower_title"), F.explode(F.sequence(F.lit(1), F.greatest(F.length(lt), F.lit(1)))).alias("i"))
    pieces = [F.when(F.col("i") + (k - 1) <= F.length("lower_title"), F.substring(F.col("lower_title"), F.col("i"), k)) for k in lengths]
    gram = pieces[0] if len(pieces) == 1 else F.explode(F.array(*pieces))
    return starts.select("movieId", "lower_title", gram.alias("gram")).filter(F.col("gram").isNotNull())


def normalise_seeds(seeds: DataFrame, query_col: str = "query") -> DataFrame:
    """``(query_id, q)`` with ``q`` stripped and lower-cased; blank seeds dropped."""
    return seeds.select("query_id", normalise_query(F.col(query_col)).alias("q")).filter(F.length("q") > 0)


def rarest_grams(movies: DataFrame, seeds: DataFrame, lengths: list[int], gram: int, small: bool) -> DataFrame:
    """``(query_id, q, gram)``: for each seed the gram that the fewest title places hold
    (ties by the gram); seeds with a gram that no title holds have no row."""
    own = seeds.select("query_id", "q", F.explode(F.array_distinct(grams(F.col("q"), F.least(F.length("q"), F.lit(gram))))).alias("gram"))
    wanted = own.select("gram").distinct()
    held = title_grams(movies, lengths).select("gram").join(joins.side(wanted, small), "gram", "left_semi")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))  # partial counts before the shuffle: no hot key
    return own.join(counts, "gram", "left").groupBy("query_id", "q").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")
    ).filter("best.n > 0").select("query_id", "q", "best.gram")


def match_seeds(movies: DataFrame, seeds: DataFrame, query_col: str = "query",
                gram: int = GRAM) -> DataFrame:
    """``(query_id, movieId, tier)`` for a table of seeds ``(query_id, <query_col>)``.

    The seeds that the exact tier hits are removed from the probe side by an anti
    join; the substring tier runs for the remaining ones.  The seed side is broadcast
    only when its rows and bytes are checked to be few (``joins.at_most``); otherwise
    the joins shuffle on their keys.
    """
    checkpoint_dir(seeds.sparkSession)
    # Used by every step below, so it is computed once.
    s = normalise_seeds(seeds, query_col).distinct().checkpoint(eager=True)
    n, size, lengths = s.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("q") + 8), F.lit(0)),
        F.sort_array(F.collect_set(F.least(F.length("q"), F.lit(gram)))),  # at most ``gram`` values
    ).first()
    small = n <= joins.BROADCAST_MAX_ROWS and size <= joins.BROADCAST_MAX_BYTES
    few = size <= joins.BROADCAST_MAX_ROWS  # seeds have no more grams than bytes
    exact = (
        movies.select("movieId", search_title(F.col("title")).alias("q"))
        .join(joins.side(s, small), "q")
        .select("query_id", "movieId", F.lit(EXACT).alias("tier"))
        .checkpoint(eager=True)  # a hit is read four times below
    )
    if not lengths:
        return exact
    remaining = s.join(exact.select("query_id").distinct(), "query_id", "left_anti")
    probes = rarest_grams(movies, remaining, lengths, gram, few)
    sub = (
        title_grams(movies, lengths)
        .join(joins.side(probes, small), "gram")
        .filter(F.col("lower_title").contains(F.col("q")))
        .select("query_id", "movieId")
        .distinct()
        .select("query_id", "movieId", F.lit(SUBSTRING).alias("tier"))
    )
    return exact.unionByName(sub)


def seed_status(seeds: DataFrame, matches: DataFrame, query_col: str = "query") -> DataFrame:
    """Per seed: ``status`` in (blank, no_match, exact, substring) and source count."""
    per = matches.groupBy("query_id").agg(
        F.min("tier").alias("tier"), F.count("*").alias("source_count")
    )
    q = normalise_query(F.col(query_col))
    return (
        seeds.select("query_id", F.col(query_col).alias("query"), q.alias("q"))
        .join(per, "query_id", "left")
        .select(
            "query_id",
            "query",
            F.when(F.coalesce(F.length("q"), F.lit(0)) == 0, F.lit("blank"))
            .when(F.col("tier").isNull(), F.lit("no_match"))
            .when(F.col("tier") == EXACT, F.lit("exact"))
            .otherwise(F.lit("substring"))
            .alias("status"),
            F.coalesce(F.col("source_count"), F.lit(0)).alias("source_count"),
        )
    )
