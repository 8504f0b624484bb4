"""Input contracts and data-quality profiles, computed over the full data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def missing_columns(required: Iterable[str], actual: Iterable[str]) -> list[str]:
    """Sorted required names absent from ``actual`` (set semantics, extras allowed)."""
    return sorted(set(required) - set(actual))


def require_columns(name: str, required: Iterable[str], actual: Iterable[str]) -> None:
    missing = missing_columns(required, actual)
    if missing:
        raise ValueError(f"{name} is missing required columns: " + ", ".join(missing))


def contract_report(headers: DataFrame, required: Mapping[str, Iterable[str]]) -> DataFrame:
    """Per file: ``(file_name, columns, missing, status)`` for a frame of headers.

    ``headers`` has ``(file_name string, columns array<string>)`` rows, one per
    file (many snapshots at once); the check is ``array_except`` per row.
    """
    spark = headers.sparkSession
    req = spark.createDataFrame(
        [(k, list(v)) for k, v in required.items()], "file_name string, required array<string>"
    )
    missing = F.array_sort(F.array_except("required", F.coalesce("columns", F.array().cast("array<string>"))))
    return (
        req.join(headers, "file_name", "left")
        .select(
            "file_name",
            "columns",
            missing.alias("missing"),
            F.when(F.col("columns").isNull(), F.lit("absent"))
            .when(F.size(missing) > 0, F.lit("invalid"))
            .otherwise(F.lit("valid"))
            .alias("status"),
        )
    )


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """``(table_name, column_name, null_count)``: one pass, then unpivoted."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])
        ).alias("s")
    )
    return stacked.select(F.lit(table_name).alias("table_name"), "s.column_name", "s.null_count")


def key_uniqueness(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """Rows, distinct non-null keys, keys occurring more than once, NULL keys."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count_if(F.col(key).isNotNull()).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    ).select(F.lit(table_name).alias("table_name"), "*")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)`` for every key value seen more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def cast_failures(text: DataFrame, schema: StructType, table_name: str) -> DataFrame:
    """Per column: non-NULL text values that do not cast to the contract type.

    ``text`` holds the raw columns as strings (e.g. a CSV read without a
    schema); the count is ``count_if(v IS NOT NULL AND try_cast(v) IS NULL)``.
    """
    fields = [f for f in schema.fields if f.name in text.columns]
    aggs = []
    for f in fields:
        v = F.col(f.name)
        bad = v.isNotNull() & v.try_cast(f.dataType).isNull()
        aggs += [F.count_if(v.isNotNull()).alias(f"{f.name}__n"), F.count_if(bad).alias(f"{f.name}__bad")]
    wide = text.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("target_type"),
                    F.col(f"{f.name}__n").alias("non_null"),
                    F.col(f"{f.name}__bad").alias("failures"),
                )
                for f in fields
            ]
        )
    )
    return wide.select(rows.alias("s")).select(F.lit(table_name).alias("table_name"), "s.*")


def malformed_records(rows: DataFrame, table_name: str, corrupt: str = "_corrupt_record", file: str = "_file") -> DataFrame:
    """``(table_name, file, record_count, malformed, example)`` per input file, for rows
    read with lineage: how many records do not fit the contract, and the raw text of
    one of them (the smallest, so that it does not depend on the order of rows)."""
    cells = [c for c in rows.columns if c not in (corrupt, file)]
    # A CSV scan judges the cells that it parses, so all of them have to be read.
    bad = F.when(F.col(corrupt).isNotNull(), F.struct(F.col(corrupt).alias("text"), F.xxhash64(*cells).alias("cells")))
    return rows.groupBy(F.col(file).alias("file")).agg(
        F.count(F.lit(1)).alias("record_count"), F.count(bad).alias("malformed"), F.min(bad).alias("first"),
    ).select(F.lit(table_name).alias("table_name"), "file", "record_count", "malformed", F.col("first.text").alias("example"))


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string (the form a header-only CSV read produces)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
