"""Genre functions over the ``|``-delimited ``genres`` string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------
GENRE_SEPARATOR = "|"
NO_GENRES_SENTINEL = "(no genres listed)"
GENRE_DISPLAY_SEPARATOR = " · "
# --------------------------------------------------------------------------------


def genre_list(genres) -> Column:
    """``Action|Drama`` -> ``["Action", "Drama"]`` (NULL stays NULL)."""
    c = F.col(genres) if isinstance(genres, str) else genres
    return F.split(c, r"\|")


def genre_display(genres) -> Column:
    """``Action|Drama`` -> ``Action · Drama``."""
    c = F.col(genres) if isinstance(genres, str) else genres
    return F.replace(c, F.lit(GENRE_SEPARATOR), F.lit(GENRE_DISPLAY_SEPARATOR))


def explode_genres(df: DataFrame, genres: str = "genres", out: str = "genre") -> DataFrame:
    """One row per (input row, genre); NULL genres and the sentinel are dropped."""
    return (
        df.filter(F.col(genres).isNotNull())
        .withColumn(out, F.explode(genre_list(genres)))
        .filter(F.col(out) != F.lit(NO_GENRES_SENTINEL))
    )
