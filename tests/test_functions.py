import pytest
from pyspark.sql import functions as F

from cofan import functions as TF
from cofan.functions import formats
from cofan.functions.genres import explode_genres
from cofan.functions.titles import search_title, year_of_date


@pytest.mark.parametrize(
    "title,clean,year,display",
    [
        ("Matrix, The (1999)", "The Matrix", "1999", "The Matrix (1999)"),
        ("Beautiful Mind, A (2001)  ", "A Beautiful Mind", "2001", "A Beautiful Mind (2001)"),
        ("X, the (2000)", "X, the", "2000", "X, the (2000)"),
        ("Nothing", "Nothing", None, "Nothing"),
        ("Apple, An (1980)", "An Apple", "1980", "An Apple (1980)"),
        ("Toy Story (1995)", "Toy Story", "1995", "Toy Story (1995)"),
    ],
)
def test_title_functions(spark, title, clean, year, display):
    df = spark.createDataFrame([(title,)], "t string")
    r = df.select(
        TF.clean_title("t").alias("c"), TF.release_year("t").alias("y"), TF.display_title("t").alias("d")
    ).collect()[0]
    assert (r["c"], r["y"], r["d"]) == (clean, year, display)


def test_search_title_keeps_trailing_space_suffix(spark):
    df = spark.createDataFrame([("Heat (1995)",), ("Heat (1995) ",), ("Matrix, The (1999)",)], "t string")
    got = [r[0] for r in df.select(search_title("t")).collect()]
    # the search suffix must end the string; the article is not moved.
    assert got == ["heat", "heat (1995) ", "matrix, the"]


def test_query_normalise_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\t Toy Story \n",)], "q string")
    assert df.select(TF.normalise_query("q")).collect()[0][0] == "toy story"


def test_genres(spark):
    df = spark.createDataFrame(
        [(1, "Action|Drama"), (2, "(no genres listed)"), (3, None), (4, "Drama")], "id int, genres string"
    )
    assert sorted(r["genre"] for r in explode_genres(df).collect()) == ["Action", "Drama", "Drama"]
    assert df.select(TF.genre_display("genres")).collect()[0][0] == "Action · Drama"


def test_formats(spark):
    df = spark.createDataFrame([(1234567, "Star*Wars~ & Co (1977)", "/x.jpg", "1999-05-01", "")],
                               "n bigint, t string, p string, d string, e string")
    r = df.select(
        formats.thousands("n").alias("n"),
        formats.search_link("t").alias("l"),
        formats.image_url("p").alias("i"),
        year_of_date("d").alias("y"),
        year_of_date("e").alias("ye"),
        formats.or_default("e", "none").alias("od"),
    ).collect()[0]
    assert r["n"] == "1,234,567"
    # form encoding: space -> '+', '*' escaped, '~' kept
    assert r["l"].endswith("?query=Star%2AWars~+%26+Co")
    assert r["i"].endswith("/x.jpg")
    assert (r["y"], r["ye"], r["od"]) == ("1999", None, "none")


def test_utc_text_is_zone_independent(spark):
    from cofan.operators.aggregates import time_range
    from cofan.schemas import RATINGS_SCHEMA

    df = spark.createDataFrame([(1, 1, 4.0, 789652004), (1, 2, 4.0, 1689843213)], RATINGS_SCHEMA)
    fold = spark.createDataFrame([(1, 1, 4.0, 1636266600)], RATINGS_SCHEMA)  # the hour New York repeats
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = time_range(df).collect()[0]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert time_range(fold).collect()[0]["earliest_utc"] == "2021-11-07 06:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r["earliest_utc"], r["latest_utc"]) == ("1995-01-09 11:46:44", "2023-07-20 08:53:33")


def test_casefold_is_full_case_folding(spark):
    from cofan.functions.titles import casefold

    texts = ["Straße", "STRASSE", "ΌΔΟΣ Σ ς", "ﬁnal ﬀ", "İstanbul", "plain ASCII 42", "", None, "ÀÉ ẞ ŉ", "Ꭰꭰ", "ǰΐև", "line\nﬆ"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", casefold("t").alias("k")).collect()
    assert [r["k"] for r in got] == [None if r["t"] is None else r["t"].casefold() for r in got]


def test_titles_match_by_case_folding(spark):
    from cofan.operators.catalog import best_matches, resolve_labels
    from cofan.schemas import CANDIDATES_SCHEMA, MOVIES_SCHEMA

    c = spark.createDataFrame(
        [("Strasse", None, 1, 1, "Other", None, "", "/a"), ("Strasse", None, 1, 2, "Straße", None, "", "/b")], CANDIDATES_SCHEMA)
    assert best_matches(c).first()["title"] == "Straße"
    m = spark.createDataFrame([(1, "Straße, Die (1999)", None)], MOVIES_SCHEMA)
    assert resolve_labels(m, spark.createDataFrame([("STRASSE, DIE",)], "label string")).first()["full_title"] == "Straße, Die (1999)"
