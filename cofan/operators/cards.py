"""Display table for a ranked result: rank, display title, genres, count text,
catalogue search link and image (from best-match picks when given)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofan.functions.formats import GENRES_UNAVAILABLE, or_default, search_link, thousands
from cofan.functions.genres import genre_display
from cofan.functions.titles import clean_title, display_title, release_year
from cofan.operators.corating import ranking_order

DEFAULT_IMAGE = "placeholder:no-poster"


def result_cards(recs: DataFrame, picks: DataFrame | None = None, default_image: str = DEFAULT_IMAGE,
                 by: list[str] | None = None) -> DataFrame:
    """One card per result row.

    ``recs`` is a co-rating result (``movieId, title, genres, fan_rating_count``;
    with ``rank`` already present for batch results).  Without ``rank`` the
    input must be a bounded top-k result: the rank window then runs over those
    rows only.  ``picks`` is ``catalog.best_matches`` output, matched on the
    clean title and the release year (NULL-safe).
    """
    by = by or []
    if "rank" not in recs.columns:
        w = Window.partitionBy(*by).orderBy(*ranking_order()) if by else Window.orderBy(*ranking_order())
        recs = recs.withColumn("rank", F.row_number().over(w))
    base = recs.select(
        *by, "rank", "movieId", "title", "genres", "fan_rating_count",
        clean_title(F.col("title")).alias("_clean"), release_year(F.col("title")).alias("_year"),
    )
    if picks is not None:
        p = picks.select(F.col("query_title").alias("_pq"), F.col("release_year").alias("_py"),
                         F.col("image_url").alias("_img"))
        base = base.join(p, (F.col("_clean") == F.col("_pq")) & F.col("_year").eqNullSafe(F.col("_py")), "left")
    else:
        base = base.withColumn("_img", F.lit(None).cast("string"))
    return base.select(
        *by,
        F.col("rank").cast("int").alias("rank"),
        "movieId",
        display_title(F.col("title")).alias("display_title"),
        genre_display(or_default("genres", GENRES_UNAVAILABLE)).alias("genres_text"),
        F.concat(thousands(F.col("fan_rating_count")), F.lit(" similar-fan ratings")).alias("count_text"),
        search_link(F.col("title")).alias("search_link"),
        F.coalesce(F.col("_img"), F.lit(default_image)).alias("image_url"),
    )
