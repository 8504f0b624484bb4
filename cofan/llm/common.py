"""Shared helpers: the shared scratch folder, written tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that separate words and that normalisation deletes: ``[\x20\x09-\x0D]``.
WHITESPACE = b" \t\n\x0b\x0c\r"
#: Deletes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_SQL = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else a folder
    already registered with the context, else one under the warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return path or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read
    back.  This cuts lineage: a lost executor costs a re-read, not a recompute.
    The shuffle files behind the table go once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path  # for drop_written
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    path = getattr(df, "_scratch", None)
    if path:
        drop_path(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Each text; null is empty.  Bytes that are not UTF-8 become U+FFFD."""
    try:
        return ["" if x is None else x for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in text_bytes(column)]


def in_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``max_bytes`` of ``column`` (a
    longer single value stays whole).  All rows pass."""
    for batch in batches:
        values = batch.column(column)
        if values.nbytes <= max_bytes:
            if batch.num_rows:
                yield batch
            continue
        offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, int(offsets[start]) + max_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def map_texts(df: DataFrame, text_col: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_slices(batches, text_col):
            yield fn(piece)

    return df.mapInArrow(run, schema)
