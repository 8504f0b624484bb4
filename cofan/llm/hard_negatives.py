"""Hard-negative mining by Four-Russians scoring.

Components become ``floor(scale * x)`` in double.  A candidate is packed once: for
every bit of its components (two's complement) and every group of eight dimensions
one byte holds that bit of the eight components.  For an anchor, a table of 256
entries per group holds the sum of every subset of its eight components.  The score
of a pair is then read from the tables: per bit-plane, the sum of one entry a group,
shifted by the plane and added, the top plane taken away.  These are the exact
inner products of all pairs; anchors go in tiles, so that one byte looks up a row of
entries.

Candidates are dealt into cells and anchors into blocks, both of bounded size, and
every block meets every cell that it needs once: first the cells of its own label,
for the positives, then all cells, for the negatives of other labels.  Each meeting
gives few rows an anchor, and a window merges them.  A label that holds a third of
the rows is dealt into as many cells as its rows need.

An anchor's positives are its ``n_pos`` best rows of the same label; for each, the
``n_neg`` best rows of other labels with ``low * positive <= 100 * negative <=
high * positive``.  Ties go to the smaller id.  Rows with a null id, label or
vector, or with a null or non-finite component take no part.  Rows that share the
anchor's id are never its positives or negatives; other repeated rows count each, and
an anchor row given twice is one anchor.  Vectors of unequal length are compared as
if padded by zeros, an empty vector scores 0.  An empty table gives an empty result;
other columns are ignored.  Scores are exact in 64 bits; a table whose components are
so large that a score could leave them raises ``OverflowError``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofan.llm.common import written

CELL, BLOCK = 1 << 16, 1 << 16  # rows of a cell, anchors of a block, at most
LEAST_CELL = 1 << 10
TILE, CHUNK = 128, 2048  # anchors and candidates scored at a time
GROUP = 8


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, v`` of the rows that take part; labels as text."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).filter(~bad)
    v = F.transform(x, lambda c: F.floor(c * scale)).cast("array<long>")
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))


def bit_planes(m: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit j of byte (r, p, g) is bit p of component
    ``8 g + j`` of row r."""
    return np.stack([np.packbits(((m >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(planes)], axis=1)


def components(bits: np.ndarray) -> np.ndarray:
    """The rows that ``bit_planes`` packed."""
    n, planes, groups = bits.shape
    out = np.zeros((n, groups * GROUP), np.int64)
    for p in range(planes):
        plane = np.unpackbits(np.ascontiguousarray(bits[:, p]), axis=1, bitorder="little").astype(np.int64)
        out += -(plane << p) if p == planes - 1 else plane << p
    return out


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components that each byte selects."""
    m, width = anchors.shape
    out = np.zeros((width // GROUP, 256, m), kind)
    for j in range(GROUP):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + anchors[:, j::GROUP].T[:, None, :].astype(kind)
    return out


def _narrow(bound: int) -> type:
    return np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64


def scores(anchors: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(anchors, rows): every exact inner product, by table lookups."""
    n, planes, groups = bits.shape
    sum_kind = _narrow(int(np.abs(anchors).sum(axis=1).max(initial=0)))
    tables = subset_sums(anchors, sum_kind)
    out = np.empty((len(anchors), n), _narrow(int(np.abs(anchors).sum(axis=1).max(initial=0)) << (planes - 1)))
    for at in range(0, n, CHUNK):
        index = np.ascontiguousarray(bits[at : at + CHUNK].transpose(1, 2, 0)).astype(np.intp)
        size = index.shape[2]
        total = np.zeros((size, len(anchors)), out.dtype)
        plane, entry = np.empty((size, len(anchors)), sum_kind), np.empty((size, len(anchors)), sum_kind)
        for p in reversed(range(planes)):
            plane[:] = 0
            for g in range(groups):
                np.take(tables[g], index[p, g], axis=0, out=entry, mode="clip")
                plane += entry
            if p == planes - 1:
                total -= plane  # the sign's plane
            else:
                total += total  # shift
                total += plane
        out[:, at : at + size] = total.T
    return out


def _pack(rows: DataFrame, planes: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            sizes = v.value_lengths().to_numpy(zero_copy_only=False)
            m = np.zeros((batch.num_rows, width), np.int64)
            if len(sizes):
                m[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = v.flatten().to_numpy()
            packed = [x.tobytes() for x in bit_planes(m, planes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "bits"])

    return rows.mapInArrow(run, "id long, label string, bits binary")


def _bits(t: pa.Table, planes: int) -> np.ndarray:
    raw = b"".join(t.column("bits").to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(t.num_rows, planes, -1)


def _tiles(anchors: pa.Table, rows: pa.Table, planes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor's place, candidate ids rising, its scores, whether labels equal),
    for every anchor of the table."""
    rows = rows.sort_by("id")
    ids, bits = rows.column("id").to_numpy(), _bits(rows, planes)
    names = {x: k for k, x in enumerate(dict.fromkeys(rows.column("label").to_pylist()))}
    labels = np.array([names[x] for x in rows.column("label").to_pylist()])
    own = anchors.column("label").to_pylist()
    values = components(_bits(anchors, planes))
    for at in range(0, anchors.num_rows, TILE):
        for k, s in enumerate(scores(values[at : at + TILE], bits), at):
            yield k, ids, s, labels == names.get(own[k], -1)


def _best_same(n_pos: int, planes: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            a, qid = anchors.column("a").to_pylist(), anchors.column("id").to_pylist()
            for k, ids, s, same in _tiles(anchors, rows, planes):
                at = np.flatnonzero(same & (ids != qid[k]))
                if len(at) > n_pos:
                    bar = np.partition(s[at], len(at) - n_pos)[len(at) - n_pos]
                    above, ties = at[s[at] > bar], at[s[at] == bar]
                    at = np.concatenate([above, ties[: n_pos - len(above)]])
                out += zip([a[k]] * len(at), ids[at].tolist(), s[at].tolist())
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "positive_id", "positive_score"), columns)})

    return run


def _best_between(n_neg: int, low: int, high: int, planes: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            a, qid, wanted = anchors.column("a").to_pylist(), anchors.column("id").to_pylist(), anchors.column("positive_scores").to_pylist()
            for k, ids, s, same in _tiles(anchors, rows, planes):
                spans = [(p, -(-low * p // 100), high * p // 100) for p in wanted[k]]
                spans = [x for x in spans if x[1] <= x[2]]
                if not spans:
                    continue
                at = np.flatnonzero((s >= min(x[1] for x in spans)) & (s <= max(x[2] for x in spans)) & ~same & (ids != qid[k]))
                by = np.argsort(-s[at].astype(np.int64), kind="stable")  # ids rise already
                at = at[by]
                falling = -s[at].astype(np.int64)
                for p, least, most in spans:
                    first = np.searchsorted(falling, -most)
                    last = min(first + n_neg, np.searchsorted(falling, -least, "right"))
                    out += zip([a[k]] * (last - first), [p] * (last - first), ids[at[first:last]].tolist(), s[at[first:last]].tolist())
        columns = list(zip(*out)) or [(), (), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "positive_score", "negative_id", "negative_score"), columns)})

    return run


def mine(
    vectors: DataFrame, anchors: Column, n_pos: int = 5, n_neg: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; ``anchors`` is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, label_col, scale)
    least, most, size = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v")), F.max(F.size("v"))).first()
    least, most, width = least or 0, most or 0, GROUP * max(1, math.ceil((size or 0) / GROUP))
    planes = 1 + max(int(most).bit_length(), int(-least - 1).bit_length() if least < 0 else 0)
    if width << (2 * planes - 2) >= 1 << 62:
        raise OverflowError(f"components of {planes} bits in {width} dimensions: scores could leave 64 bits")
    packed = written(_pack(rows, planes, width), "hard-rows")
    asked = written(packed.filter(anchors).distinct().select(F.monotonically_increasing_id().alias("a"), "id", "label", "bits"), "hard-anchors")
    n, n_label = packed.groupBy("label").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    n_asked, n_asked_label = asked.groupBy("label").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    cell = min(CELL, max(LEAST_CELL, math.ceil((n or 0) / (4 * spark.sparkContext.defaultParallelism))))

    def meet(left: DataFrame, n_left: int | None, n_right: int | None, by: list[str], run, schema: str) -> DataFrame:
        """Every block of ``left`` with every cell of the rows, for each value of ``by``."""
        cells, blocks = max(1, math.ceil((n_right or 0) / cell)), max(1, math.ceil((n_left or 0) / BLOCK))
        dealt = lambda df, own, count, other, copies: df.withColumn(own, F.pmod(F.xxhash64("id", "bits"), F.lit(count)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        x, y = dealt(left, "block", blocks, "cell", cells), dealt(packed, "cell", cells, "block", blocks)
        return x.groupBy(*by, "block", "cell").cogroup(y.groupBy(*by, "block", "cell")).applyInArrow(run, schema)

    found = meet(asked, n_asked_label, n_label, ["label"], _best_same(n_pos, planes), "a long, positive_id long, positive_score long")
    order = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    positives = written(found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n_pos).drop("r"), "hard-positives")
    known = asked.join(positives.groupBy("a").agg(F.collect_set("positive_score").alias("positive_scores")), "a")
    near = meet(known, n_asked, n, [], _best_between(n_neg, low, high, planes), "a long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("a", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_neg)
    return positives.join(near, ["a", "positive_score"]).join(asked.select("a", F.col("id").alias("anchor_id")), "a").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
