from cofan.operators import catalog as C
from cofan.schemas import CANDIDATES_SCHEMA


def test_best_match_cases(spark):
    cands = spark.createDataFrame(
        [
            ("heat", "1995", 1, 0, "Heat", None, "1986-01-01", "/a"),
            ("heat", "1995", 1, 1, "Heat", None, "1995-12-15", "/b"),
            ("x", None, 1, 0, "X", None, "2000-01-01", "/c"),
            ("x", None, 1, 1, "X", None, None, "/d"),
            ("y", "2001", 1, 0, "Q", None, "1999", "/e"),
            ("y", "2001", 2, 0, "Z", None, "2001-02-02", "/f"),
            ("n", "1990", 1, 0, "A", None, "1980-01-01", ""),
            ("n", "1990", 1, 1, "A", None, "1980-01-01", "/g"),
            ("o", None, 1, 0, "Other", "O", "2000", "/h"),
            ("none", None, 1, 0, "None", None, None, None),
        ],
        CANDIDATES_SCHEMA,
    )
    got = {r["query_title"]: (r["poster_path"], r["match_tier"]) for r in C.best_matches(cands).collect()}
    assert got == {
        "heat": ("/b", "title_and_year"),
        "x": ("/d", "title_and_year"),
        "y": ("/f", "year"),
        "n": ("/g", "fallback"),
        "o": ("/h", "title"),
    }


def test_first_attempt_wins_over_better_tier_later(spark):
    cands = spark.createDataFrame(
        [
            ("k", "2000", 1, 5, "Zzz", None, "2000-01-01", "/year-hit"),
            ("k", "2000", 2, 0, "K", None, "2000-01-01", "/both-hit"),
        ],
        CANDIDATES_SCHEMA,
    )
    assert C.best_matches(cands).collect()[0]["poster_path"] == "/year-hit"


def test_resolve_labels(spark):
    movies = spark.createDataFrame(
        [(1, "Matrix, The (1999)", "A"), (2, "Matrix, The (2003)", "A"), (3, "Toy Story (1995)", "B")],
        "movieId int, title string, genres string",
    )
    labels = spark.createDataFrame([(x,) for x in C.POPULAR_LABELS], "label string")
    got = {r["label"]: r["full_title"] for r in C.resolve_labels(movies, labels).collect()}
    assert got["The Matrix"] == "Matrix, The (1999)"
    assert got["Toy Story"] == "Toy Story (1995)"
    assert got["Inception"] is None


def test_listing_lookup_count(spark, ratings, movies):
    assert [r[0] for r in C.title_listing(movies).collect()][0] == "Inception (2010)"
    assert C.title_lookup(movies, "Jumanji (1995)").collect()[0]["movieId"] == 2
    assert C.movie_rating_count(ratings, 2571).collect()[0]["rating_count"] == 3


def test_cards(spark, ratings, movies):
    from cofan.operators import corating
    from cofan.operators.cards import result_cards

    recs = corating.recommend_similar(ratings, movies, "Toy Story")
    picks = spark.createDataFrame([("The Shawshank Redemption", "1994", "http://img/x")],
                                  "query_title string, release_year string, image_url string")
    cards = result_cards(recs, picks).orderBy("rank").collect()
    assert [c["rank"] for c in cards] == [1, 2, 3]
    assert cards[0]["display_title"] == "Inception (2010)"
    assert cards[2]["image_url"] == "http://img/x"
    assert cards[0]["count_text"] == "2 similar-fan ratings"
    assert cards[1]["genres_text"] == "Action · Sci-Fi · Thriller"
    assert cards[2]["search_link"].endswith("query=The+Shawshank+Redemption")


def test_movie_panel(spark, ratings):
    from cofan.schemas import MOVIES_SCHEMA

    movies = spark.createDataFrame(
        [(1, "Toy Story (1995)", "Adventure|Animation"), (7, "Nothing", None), (8, "Matrix, The (1999)", "")],
        MOVIES_SCHEMA,
    )
    p = C.movie_panel(movies, ratings, "Toy Story (1995)").collect()[0]
    assert (p["display_title"], p["year_text"], p["genres_text"], p["rating_count"], p["rating_text"]) == (
        "Toy Story (1995)", "1995", "Adventure · Animation", 3, "3 ratings")
    q = C.movie_panel(movies, ratings, "Nothing").collect()[0]
    assert (q["year_text"], q["genres_text"], q["rating_count"]) == ("Year unavailable", "Genres unavailable", 0)
    r = C.movie_panel(movies, ratings, "Matrix, The (1999)").collect()[0]
    assert (r["display_title"], r["genres_text"]) == ("The Matrix (1999)", "Genres unavailable")
    assert C.movie_panel(movies, ratings, "absent").count() == 0


def test_best_match_reads_every_candidate(spark, tmp_path):
    """Keys of every remainder of nine, under a query without a year (attempt 1 alone)
    and under one with a year."""
    from cofan.plans import queries
    from cofan.sources import testdata

    rows = [(k, f"{w}{k} ring", "Brand#1", "Type", 10) for k in (11, 14, 16, 17, 22) for w in ("a", "bc")]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    part.write.parquet(str(tmp_path / "part.parquet"))
    got = {(r["query_title"], r["attempt"]) for r in queries.catalog_best_match(spark, str(tmp_path)).collect()}
    assert got == {(q, 1) for w in ("a", "bc") for k in (11, 14, 16, 17, 22) for q in (f"{w}{k}", f"{w}{k} ring")}
    assert testdata.catalogue_candidates(part).filter("attempt = 1").count() == 2 * len(rows)
