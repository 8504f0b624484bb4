import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MOVIES = [
    (1, "Toy Story (1995)", "Adventure|Animation|Children|Comedy|Fantasy"),
    (2, "Jumanji (1995)", "Adventure|Children|Fantasy"),
    (2571, "The Matrix (1999)", "Action|Sci-Fi|Thriller"),
    (79132, "Inception (2010)", "Action|Sci-Fi|Thriller"),
    (318, "The Shawshank Redemption (1994)", "Crime|Drama"),
]
_R = [
    (1, 1, 5.0), (1, 2571, 5.0), (1, 79132, 4.5),
    (2, 1, 4.5), (2, 2571, 4.5), (2, 318, 5.0),
    (3, 1, 5.0), (3, 79132, 5.0), (3, 318, 4.5),
    (4, 2, 5.0), (4, 2571, 4.5), (4, 318, 4.0),
]
RATINGS = [(u, m, r, 1000000001 + i) for i, (u, m, r) in enumerate(_R)]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="cofan-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("cofan-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def movies(spark):
    from cofan.schemas import MOVIES_SCHEMA

    return spark.createDataFrame(MOVIES, MOVIES_SCHEMA)


@pytest.fixture(scope="session")
def ratings(spark):
    from cofan.schemas import RATINGS_SCHEMA

    return spark.createDataFrame(RATINGS, RATINGS_SCHEMA)


def write_fixture_csv(path, movies_text=None, ratings_text=None):
    os.makedirs(path, exist_ok=True)
    if movies_text is None:
        movies_text = "movieId,title,genres\n" + "".join(f"{m},{t},{g}\n" for m, t, g in MOVIES)
    if ratings_text is None:
        ratings_text = "userId,movieId,rating,timestamp\n" + "".join(f"{u},{m},{r},{t}\n" for u, m, r, t in RATINGS)
    with open(os.path.join(path, "movies.csv"), "w", encoding="utf-8") as f:
        f.write(movies_text)
    with open(os.path.join(path, "ratings.csv"), "w", encoding="utf-8") as f:
        f.write(ratings_text)
    return path


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
