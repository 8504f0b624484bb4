"""Parquet readers for a ratings / movies snapshot (the columnar form of the CSV contract)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cofan.operators.quality import require_columns
from cofan.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA


def read_contract_parquet(spark: SparkSession, path: str, schema: StructType, cast: bool = False) -> DataFrame:
    """Contract columns by name, in contract order; extra columns are pruned from the scan.

    ``cast=True`` converts to the contract types (``try_cast``: values that do
    not fit become NULL, as a CSV read would give); otherwise stored types are
    kept (e.g. 64-bit ids).
    """
    df = spark.read.parquet(path)
    require_columns(os.path.basename(path.rstrip("/")), schema.fieldNames(), df.columns)
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) if cast else F.col(f.name) for f in schema.fields]
    return df.select(*cols)


def load(spark: SparkSession, data_path: str, cast: bool = False,
         ratings_name: str = "ratings", movies_name: str = "movies") -> tuple[DataFrame, DataFrame]:
    """``(ratings, movies)`` from ``<data_path>/<ratings_name>`` and ``<movies_name>`` Parquet folders."""
    return (
        read_contract_parquet(spark, os.path.join(data_path, ratings_name), RATINGS_SCHEMA, cast),
        read_contract_parquet(spark, os.path.join(data_path, movies_name), MOVIES_SCHEMA, cast),
    )
