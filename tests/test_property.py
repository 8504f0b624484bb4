"""Random small tables: single-seed and batch recommendations equal a brute force
written directly from the rules (exact tier else substring tier, inclusive
threshold, fans de-duplicated, rating rows counted, sources excluded, inner join
to titles, count desc / title / id order)."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cofan.operators import corating
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

TITLES = ["Alpha (1990)", "Beta (1991)", "Alpha Beta (1992)", "Gamma", "The Delta (2000)", "Alpha (1995)",
          "Delta, The (2001)", "Omega (1999) "]
SEEDS = ["alpha", "Beta", "alpha beta", "the", "a", "Gamma (1990)", "zz", " delta, the ", "omega"]
HALF_STEPS = [x / 2 for x in range(1, 11)]


def brute(ratings, movies, seed, top_n, min_rating):
    q = seed.strip().lower()
    search = lambda t: re.sub(r"\s*\(\d{4}\)$", "", t).lower()
    exact = {m for m, t, _ in movies if search(t) == q}
    src = exact or {m for m, t, _ in movies if q in t.lower()}
    if not src:
        return []
    fans = {u for u, m, r, _ in ratings if m in src and r >= min_rating}
    counts = Counter(m for u, m, r, _ in ratings if u in fans and r >= min_rating and m not in src)
    rows = [(m, t, c) for m, c in counts.items() for mm, t, _ in movies if mm == m]
    rows.sort(key=lambda x: (-x[2], x[1], x[0]))
    return [(m, c) for m, _, c in rows[:top_n]]


tables = st.tuples(
    st.lists(st.tuples(st.integers(1, 8), st.integers(1, 9), st.sampled_from(HALF_STEPS)), min_size=1, max_size=40),
    st.lists(st.sampled_from(range(len(TITLES))), min_size=1, max_size=8),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(tables=tables, top_n=st.integers(1, 5), min_rating=st.sampled_from([3.0, 4.5, 5.0]))
def test_recommendations_equal_brute_force(spark, tables, top_n, min_rating):
    raw, title_idx = tables
    ratings = [(u, m, r, i) for i, (u, m, r) in enumerate(raw)]
    # movie ids 1..len(title_idx); ids 9 and above may be rated but have no metadata
    movies = [(i + 1, TITLES[t], "G") for i, t in enumerate(title_idx)]
    r_df = spark.createDataFrame(ratings, RATINGS_SCHEMA)
    m_df = spark.createDataFrame(movies, MOVIES_SCHEMA)
    seeds = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(SEEDS)], "query_id string, query string")
    batch = {}
    for row in corating.recommend_batch(r_df, m_df, seeds, top_n=top_n, min_rating=min_rating).collect():
        batch.setdefault(row["query_id"], []).append((row["rank"], row["movieId"], row["fan_rating_count"]))
    for i, seed in enumerate(SEEDS):
        expected = brute(ratings, movies, seed, top_n, min_rating)
        assert [(m, c) for _, m, c in sorted(batch.get(f"s{i}", []))] == expected, seed
    for seed in ("alpha", "the", "Gamma (1990)"):
        single = corating.recommend_similar(r_df, m_df, seed, top_n=top_n, min_rating=min_rating, check=False)
        assert [(x["movieId"], x["fan_rating_count"]) for x in single.collect()] == brute(
            ratings, movies, seed, top_n, min_rating
        ), seed


def brute_best(cands, query, year):
    """The least usable candidate by (no tier, attempt, tier, position)."""

    def order(c):
        named = query.casefold() in ((c["title"] or "").casefold(), (c["original_title"] or "").casefold())
        when = c["release_date"] or ""
        dated = (when[:4] if len(when) > 3 else None) == year
        tier = (1 if dated else 2) if named else 3 if dated and year else 4
        return tier == 4, c["attempt"], tier, c["position"]

    return min((c for c in cands if c["poster_path"]), key=order, default=None)


cand_rows = st.lists(
    st.fixed_dictionaries(
        {
            "attempt": st.sampled_from([1, 2]),
            "title": st.sampled_from(["Heat", "HEAT", "Other", None, ""]),
            "original_title": st.sampled_from(["heat", "Else", None]),
            "release_date": st.sampled_from(["1995-12-15", "1986-01-01", "1995", "19", "", None]),
            "poster_path": st.sampled_from(["/a", "/b", "", None]),
        }
    ),
    min_size=0,
    max_size=8,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=cand_rows, year=st.sampled_from([None, "1995", "1986"]))
def test_best_match_equals_brute_force(spark, rows, year):
    from cofan.operators.catalog import best_matches
    from cofan.schemas import CANDIDATES_SCHEMA

    cands = [dict(r, position=i) for i, r in enumerate(rows) if year or r["attempt"] == 1]
    df = spark.createDataFrame(
        [("heat", year, c["attempt"], c["position"], c["title"], c["original_title"], c["release_date"],
          c["poster_path"]) for c in cands],
        CANDIDATES_SCHEMA,
    )
    got = best_matches(df).collect()
    expected = brute_best(cands, "heat", year)
    if expected is None:
        assert got == []
    else:
        assert len(got) == 1
        assert (got[0]["attempt"], got[0]["position"]) == (expected["attempt"], expected["position"])


agg_rows = st.lists(
    st.tuples(st.integers(1, 6), st.integers(1, 7), st.sampled_from(HALF_STEPS + [None])), min_size=1, max_size=40
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=agg_rows, n_movies=st.integers(1, 7))
def test_aggregate_reports_equal_brute_force(spark, raw, n_movies):
    from decimal import ROUND_HALF_UP, Decimal

    from cofan.operators import aggregates as A

    ratings = [(u, m, r, i) for i, (u, m, r) in enumerate(raw)]
    movies = [(i, f"T{(i * 5) % 3} ({1990 + i})", "G") for i in range(1, n_movies + 1)]
    r_df = spark.createDataFrame(ratings, RATINGS_SCHEMA)
    m_df = spark.createDataFrame(movies, MOVIES_SCHEMA)
    title = {m: t for m, t, _ in movies}

    counts = Counter(m for _, m, _, _ in ratings)
    vals = {}
    for _, m, r, _ in ratings:
        if r is not None:
            vals.setdefault(m, []).append(r)
    mean = {m: float(Decimal(repr(sum(v) / len(v))).quantize(Decimal("0.001"), ROUND_HALF_UP)) for m, v in vals.items()}
    top = sorted(
        ((m, c, mean.get(m)) for m, c in counts.items() if m in title),
        key=lambda x: (-x[1], -(x[2] if x[2] is not None else float("-inf")), title[x[0]], x[0]),
    )[:5]
    got = [(x["movieId"], x["rating_count"], x["average_rating"]) for x in A.top_movies(r_df, m_df, 5).collect()]
    assert got == top

    most = sorted(((m, c) for m, c in counts.items() if m in title), key=lambda x: (-x[1], title[x[0]], x[0]))[:3]
    assert [(x["movieId"], x["rating_count"]) for x in A.most_rated(r_df, m_df, 3).collect()] == most

    o = A.overview(r_df).collect()[0]
    rs = [r for _, _, r, _ in ratings if r is not None]
    assert (o["rating_rows"], o["unique_users"], o["unique_movies_rated"]) == (
        len(ratings), len({u for u, _, _, _ in ratings}), len(counts))
    assert (o["minimum_rating"], o["maximum_rating"]) == ((min(rs), max(rs)) if rs else (None, None))
    assert (o["average_rating"] is None and not rs) or abs(o["average_rating"] - sum(rs) / len(rs)) < 1e-12

    dist = sorted(Counter(r for _, _, r, _ in ratings).items(), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [(x["rating"], x["rating_count"]) for x in A.rating_distribution(r_df).collect()] == dist
