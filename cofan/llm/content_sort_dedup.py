r"""Exact deduplication by content sort.

Rows are range-partitioned by sampled splitters over the normalised bytes,
sorted inside each range with Spark's external sort, and compared in full with
their neighbour.  Two texts are equal when identical after deleting every
character of ``[\x20\x09-\x0D]``.

* Splitters compare the first ``HEAD_BYTES`` normalised bytes and, where these
  tie, the SHA-256 of the whole normalised text.  The splitter sample that
  reaches the driver therefore has keys of bounded size, however long the texts.
* Of equal texts the row with the most code points, then the smallest id stays.
  Both are trailing sort keys, so the first row of a run is the one that stays
  and a group holding a third of all rows is cut over many ranges.
* A run that crosses a range boundary is completed from one row per range end
  (at most two per partition, hence broadcast).  There, equality is that of
  digest and normalised length; inside a range it is that of the bytes.

Null text counts as empty; null ids sort after all others; repeated rows are
members of one group.  An empty table gives an empty result.  Other columns are
ignored (``annotate``) or carried unchanged (``keep_one``), whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import WHITESPACE, in_slices, text_bytes, written

HEAD_BYTES = 64
PRE = "__cs_"  # prefix of working columns; clashing input columns are renamed


def _normalise(text: bytes) -> bytes:
    return text.translate(None, WHITESPACE)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the sort key to rows (id, text, extra)."""
    schema = T.StructType(rows.schema.fields + [T.StructField("head", T.BinaryType()), T.StructField("digest", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            norms = [_normalise(x) for x in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n[:HEAD_BYTES] for n in norms], pa.binary()),
                 pa.array([hashlib.sha256(n).digest() for n in norms], pa.binary())],
                names=[*batch.schema.names, "head", "digest"],
            )

    return rows.mapInArrow(run, schema).withColumn("points", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def _sorted(rows: DataFrame) -> DataFrame:
    best = [F.desc("points"), F.asc_nulls_last("id")]
    return (
        _keyed(rows)
        .repartitionByRange("head", "digest", *best)
        .sortWithinPartitions("head", "digest", *best)
    )


class _Run:
    """One run of equal neighbours inside a partition."""

    def __init__(self, norm: bytes, digest: bytes, keep) -> None:
        self.norm, self.digest, self.keep = norm, digest, keep
        self.ids: list = []


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Run, bool]]:
    """Runs of a sorted partition, each with whether it touches an end of it.
    Only the ids of the current run and the previous one are held."""
    last: _Run | None = None
    first = True
    for batch in in_slices(batches, "text"):
        for ident, text, digest in zip(batch.column("id").to_pylist(), text_bytes(batch.column("text")), batch.column("digest").to_pylist()):
            norm = _normalise(text)
            if last is None or digest != last.digest or norm != last.norm:
                if last is not None:
                    yield last, first
                    first = False
                last = _Run(norm, digest, ident)
            last.ids.append(ident)
    if last is not None:
        yield last, True


def _members(id_type: pa.DataType):
    """Rows of each run: what stays and how many rows the run has here."""

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        types = [id_type, id_type, pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32()]
        names = ["id", "keep_id", "n", "digest", "norm_bytes", "starts", "edge", "part"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        for r, edge in _runs(batches):
            for k, ident in enumerate(r.ids):
                out.append((ident, r.keep, len(r.ids), r.digest.hex(), len(r.norm), k == 0, edge, part))
                if len(out) == 8192:
                    yield emit(out)
                    out = []
        if out:
            yield emit(out)

    return run


def _completed(edges: DataFrame) -> DataFrame:
    """Runs cut by range boundaries, put together: at most two rows per partition."""
    return edges.groupBy("digest", "norm_bytes").agg(F.min_by("keep_id", "part").alias("whole_keep"), F.sum("n").alias("whole_n"), F.min("part").alias("whole_part"))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("keep_id", kind), T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("norm_bytes", T.LongType()), T.StructField("starts", T.BooleanType()), T.StructField("edge", T.BooleanType()), T.StructField("part", T.IntegerType())])
    members = written(_sorted(rows).mapInArrow(_members(to_arrow_type(kind)), schema), "exact-runs")
    whole = _completed(members.filter("edge AND starts"))
    return members.join(F.broadcast(whole), ["digest", "norm_bytes"], "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("edge"), F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("whole_n")).otherwise(F.col("n")).alias("group_size"),
        # Only the first row of a run is the one that stays, also where ids repeat.
        (F.col("starts") & (~F.col("edge") | (F.col("part") == F.col("whole_part")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Inside the sorted ranges all but the first row of each run go at once; the
    rest of a run that crosses ranges goes by the completed run's first range.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[F.col(c) for c in docs.columns if c != text_col] or [F.lit(0).alias("_")]).alias("rest"))
    schema = T.StructType(rows.schema.fields + [T.StructField(n, t) for n, t in (("digest", T.StringType()), ("norm_bytes", T.LongType()), ("edge", T.BooleanType()), ("part", T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        digest, norm, first = None, None, True
        held = None  # the last run's first row: an edge only if no other run follows

        def flagged(row: pa.RecordBatch, d: bytes, size: int, edge: bool) -> pa.RecordBatch:
            extra = [pa.array([d.hex()]), pa.array([size], pa.int64()), pa.array([edge]), pa.array([part], pa.int32())]
            return pa.RecordBatch.from_arrays([row.column("id"), row.column("text"), row.column("rest"), *extra], names=schema.names)

        waiting: list[pa.RecordBatch] = []
        for batch in in_slices(batches, "text"):
            for k, (text, d) in enumerate(zip(text_bytes(batch.column("text")), batch.column("digest").to_pylist())):
                n = _normalise(text)
                if d != digest or n != norm:
                    if held is not None:
                        waiting.append(flagged(*held, first))
                        first = False
                    digest, norm, held = d, n, (batch.slice(k, 1), d, len(n))
            if waiting:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting = []
        if held is not None:
            yield flagged(*held, True)

    kept = written(_sorted(rows).mapInArrow(run, schema), "exact-kept")
    whole = kept.filter("edge").groupBy("digest", "norm_bytes").agg(F.min("part").alias("whole_part"))
    out = kept.join(F.broadcast(whole), ["digest", "norm_bytes"], "left").filter("NOT edge OR part = whole_part")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])
