"""Writers for batch outputs and run records (all through Spark's writers)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofan.functions.formats import utc_iso_now


def write_csv(df: DataFrame, out_dir: str, single_file: bool = False) -> str:
    """Overwrite ``out_dir`` with CSV files that have a header, one a partition;
    ``single_file`` is for bounded results (top-k reports)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(out_dir)
    return out_dir


def write_parquet(df: DataFrame, out_dir: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out_dir)
    return out_dir


def run_record(spark: SparkSession, record: dict) -> DataFrame:
    """One-row DataFrame of nested structs from a JSON-able dict, plus ``completed_at``."""
    doc = json.dumps(record, sort_keys=True, default=str)
    parsed = spark.createDataFrame([(doc,)], "doc string").select(
        F.from_json("doc", F.schema_of_json(F.lit(doc))).alias("r")
    )
    return parsed.select("r.*", utc_iso_now().alias("completed_at"))


def append_run_record(spark: SparkSession, record: dict, out_dir: str) -> str:
    """Append the record as JSON lines to ``out_dir`` (history is kept)."""
    run_record(spark, record).coalesce(1).write.mode("append").json(out_dir)
    return out_dir


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
