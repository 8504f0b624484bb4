"""Table contracts."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

RATINGS_SCHEMA = StructType(
    [
        StructField("userId", IntegerType(), True),
        StructField("movieId", IntegerType(), True),
        StructField("rating", DoubleType(), True),
        StructField("timestamp", LongType(), True),
    ]
)

MOVIES_SCHEMA = StructType(
    [
        StructField("movieId", IntegerType(), True),
        StructField("title", StringType(), True),
        StructField("genres", StringType(), True),
    ]
)

# Search candidates from an external movie catalogue, one row per returned
# result; ``attempt`` is the search attempt (1 = title only, 2 = title + year),
# ``position`` the rank inside that attempt's result list.
CANDIDATES_SCHEMA = StructType(
    [
        StructField("query_title", StringType(), True),
        StructField("release_year", StringType(), True),
        StructField("attempt", IntegerType(), True),
        StructField("position", IntegerType(), True),
        StructField("title", StringType(), True),
        StructField("original_title", StringType(), True),
        StructField("release_date", StringType(), True),
        StructField("poster_path", StringType(), True),
    ]
)

TABLE_SCHEMAS = {"ratings": RATINGS_SCHEMA, "movies": MOVIES_SCHEMA}

# Required column names per input file (a set: order is not part of the contract).
REQUIRED_COLUMNS = {
    "ratings.csv": ("userId", "movieId", "rating", "timestamp"),
    "movies.csv": ("movieId", "title", "genres"),
}
