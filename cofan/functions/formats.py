"""Display and time formatting functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cofan.functions.titles import clean_title

# ---- fixed values -------------------------------------------------------------
CATALOGUE_SEARCH_URL = "https://www.themoviedb.org/search/movie?query="
POSTER_BASE_URL = "https://image.tmdb.org/t/p/w500"
YEAR_UNAVAILABLE = "Year unavailable"
GENRES_UNAVAILABLE = "Genres unavailable"
# --------------------------------------------------------------------------------


def thousands(n) -> Column:
    """Integer with thousands separators: 1234567 -> ``1,234,567``."""
    c = F.col(n) if isinstance(n, str) else n
    return F.format_number(c, 0)


def form_encode(text) -> Column:
    """``application/x-www-form-urlencoded`` text with space as ``+``.

    ``url_encode`` (Java) escapes ``~`` and keeps ``*``; the form encoding used
    for search links keeps ``~`` and escapes ``*``: patch both.
    """
    c = F.col(text) if isinstance(text, str) else text
    encoded = F.url_encode(c)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_link(title, base: str = CATALOGUE_SEARCH_URL) -> Column:
    """Catalogue search URL for the clean form of a title."""
    return F.concat(F.lit(base), form_encode(clean_title(title)))


def image_url(poster_path, base: str = POSTER_BASE_URL) -> Column:
    c = F.col(poster_path) if isinstance(poster_path, str) else poster_path
    return F.concat(F.lit(base), c)


def utc_iso_now() -> Column:
    """Current instant as ISO-8601 text with a ``+00:00`` offset, whatever the session zone."""
    return F.date_format(
        utc_wall(F.unix_micros(F.current_timestamp())),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
    )


def utc_wall(micros) -> Column:
    """Microseconds since the epoch -> UTC wall time without a zone; no hour is lost
    or repeated, as the session zone takes no part."""
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_to_utc(seconds) -> Column:
    """Unix seconds -> timestamp (an instant)."""
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_seconds(c)


def or_default(c, default: str) -> Column:
    """Value, or ``default`` when it is NULL or the empty string."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit(default))
