"""Dense int ids for wide or sparse keys.

Spark ML's ALS takes 32-bit ids.  ``dense_index`` numbers the distinct keys of a
column 0, 1, 2, ... in key order without a global sort in one task: the keys are range
partitioned and sorted inside their partitions, the rows per partition are counted,
and a key's number is its place in the partition plus the rows of the partitions
before.  Only one count a partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofan.session import checkpoint_dir

MAX_IDS = (1 << 31) - 1
# monotonically_increasing_id holds the partition above this bit, the row below it.
_ROW_BITS = 33


def dense_index(df: DataFrame, key: str, name: str) -> DataFrame:
    """``(key, name)``: the distinct non-NULL keys and their numbers from 0 (int)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    # Checkpointed, so that a lost executor cannot give a key another number.
    placed = (
        keys.repartitionByRange(F.col(key)).sortWithinPartitions(key)
        .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    )
    part = F.shiftrightunsigned("_at", _ROW_BITS).cast("int")
    sizes = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    before, total = [], 0
    for row in sizes:
        before.append((row["_part"], total))
        total += row["count"]
    if total > MAX_IDS:
        raise ValueError(f"{total} distinct values of {key} do not fit 32-bit ids")
    offsets = spark.createDataFrame(before, "_part int, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row per partition
        .select(key, place.cast("int").alias(name))
    )


def index_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(indexed, users, items)``: ratings with dense int ``userId`` and ``movieId``,
    and the tables that map them back.  Rows with a NULL id are left out."""
    users, items = dense_index(ratings, "userId", "user_idx"), dense_index(ratings, "movieId", "item_idx")
    indexed = ratings.join(users, "userId").join(items, "movieId").select(
        F.col("user_idx").alias("userId"), F.col("item_idx").alias("movieId"), "rating"
    )
    return indexed, users, items


def restore(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` with the ids that ``index_ratings`` replaced."""
    rest = [c for c in rows.columns if c not in ("userId", "movieId")]
    named = rows.withColumnsRenamed({"userId": "user_idx", "movieId": "item_idx"})
    return named.join(users, "user_idx").join(items, "item_idx").select("userId", "movieId", *rest)
