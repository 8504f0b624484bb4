"""Title functions (search title, release year, clean and display titles).

All are ``Column`` expressions built from ``regexp_replace`` /
``regexp_extract``, so they stay inside whole-stage codegen; no Python UDF.
Regex dialect is Java's: ``\\d`` is ASCII-only and ``$`` also matches before
a final line terminator.
"""

from __future__ import annotations

import json
import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the source behaviour) -------------------------
# Year suffix removed for title search: optional spaces, "(dddd)" at the end.
SEARCH_YEAR_SUFFIX = r"(?U)\s*\([0-9]{4}\)$"
# Release year: the last "(dddd)", trailing whitespace allowed after it.
RELEASE_YEAR_PATTERN = r"(?U)\(([0-9]{4})\)\s*$"
# Trailing article moved to the front: "Matrix, The" -> "The Matrix".
TRAILING_ARTICLE_PATTERN = r"^(.+), (The|A|An)$"
TRAILING_ARTICLE_REPLACEMENT = "$2 $1"
# ------------------------------------------------------------------------------

_EDGE_WS = r"(?U)^\s+|\s+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace (tabs and newlines too)."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def search_title(title) -> Column:
    """Lower-cased title without its ``(YYYY)`` suffix; what exact search compares."""
    return F.lower(F.regexp_replace(_col(title), SEARCH_YEAR_SUFFIX, ""))


def normalise_query(query) -> Column:
    """Search text as typed -> stripped and lower-cased."""
    return F.lower(strip_ws(query))


def release_year(title) -> Column:
    """Release year string from a ``... (YYYY)`` title, NULL when absent."""
    return F.nullif(F.regexp_extract(_col(title), RELEASE_YEAR_PATTERN, 1), F.lit(""))


def clean_title(title) -> Column:
    """Title without the year suffix, trimmed, with a trailing article moved first."""
    without_year = strip_ws(F.regexp_replace(_col(title), RELEASE_YEAR_PATTERN, ""))
    return F.regexp_replace(without_year, TRAILING_ARTICLE_PATTERN, TRAILING_ARTICLE_REPLACEMENT)


def display_title(title) -> Column:
    """Clean title plus `` (YYYY)`` when the title carries a year."""
    year = release_year(title)
    clean = clean_title(title)
    return F.when(year.isNull(), clean).otherwise(F.concat(clean, F.lit(" ("), year, F.lit(")")))


def year_of_date(date_text) -> Column:
    """First four characters of a date string when it has at least four, else NULL."""
    d = _col(date_text)
    return F.when(F.length(d) >= 4, F.substring(d, 1, 4))


def text_or_empty(c) -> Column:
    """String form of a value, empty string for NULL."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


@lru_cache(maxsize=1)
def folding() -> tuple[str, str, dict[str, str]]:
    """Full case folding beyond lower case: the characters that fold to one other
    character, what they fold to, and those that fold to several."""
    lower = (chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    folds = {c: c.casefold() for c in lower if c.lower() == c != c.casefold()}
    one = {c: f for c, f in folds.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in folds.items() if len(f) > 1}


def casefold(c) -> Column:
    """Case-insensitive comparison key: Unicode full case folding ("Straße" as
    "strasse").  Texts without a character beyond ASCII are only lower-cased."""
    text = _col(c)
    source, target, several = folding()
    low = F.translate(F.lower(text), source, target)
    known = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    wide = F.array_join(F.transform(F.split(low, ""), lambda x: F.coalesce(F.element_at(known, x), x)), "")
    folded = F.when(low.rlike("[" + "".join(several) + "]"), wide).otherwise(low)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)
