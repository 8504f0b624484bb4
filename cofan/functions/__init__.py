"""Column functions: pure ``Column -> Column`` builders, evaluated JVM-side."""

from cofan.functions.titles import (  # noqa: F401
    clean_title,
    display_title,
    normalise_query,
    release_year,
    search_title,
    strip_ws,
)
from cofan.functions.genres import genre_display, genre_list  # noqa: F401
