"""Exact top-k inner products by no-random-access aggregation.

Vectors are dealt into cells and queries into blocks, both of bounded size; every block
meets every cell once.  A cell is read in parts of ``PART`` candidates.  In a part each
dimension is a list sorted by value, read from the end that a query's sign calls for.
Lists are read in step, to the depths ``DEPTHS`` (shares of the part): a candidate's
lower bound takes the worst value of each list that has not shown it, its upper bound
the value that the list has reached.  A query stops when no more than a few outsiders
can still qualify: their upper bounds reach neither the k-th lower bound nor the k-th
best score of the parts before.  The scores of those that are left are then resolved,
and the k best per cell are merged to the k best of all.

The bounds of a tile of queries and of all candidates of a part are two matrix
products, over lists whose unread values are replaced by the bound.  They are sums of
integers in float64, exact below 2^53; larger components take integer products, and a
table whose scores could leave 64 bits raises ``OverflowError``.

Components become ``floor(1024 * x)`` in double.  Vectors that are null, empty or
hold null or non-finite components take no part; nor do null ids.  Vectors of
unequal length are compared as if padded by zeros.  Ties go to the smaller id.
Repeated rows are candidates each; a query leaves out the rows with its own id, and
queries that share an id give one list over all of them.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofan.llm.common import written

CELL, BLOCK = 1 << 16, 1 << 16  # candidates of a cell, queries of a block, at most
LEAST_CELL = 1 << 10
PART, TILE = 1 << 12, 256
DEPTHS = (0.5, 0.75, 0.9)
SCALE = 1024


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(c * SCALE))
    bad = F.exists(F.col(vector_col).cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(~bad)
    return rows.select(F.col(id_col).cast("long").alias("id"), x.cast("array<long>").alias("v"))


class Lists:
    """The sorted lists of one part of a cell; ids rise."""

    def __init__(self, ids: np.ndarray, m: np.ndarray) -> None:
        self.ids, self.m = ids, m
        order = np.argsort(m, axis=0, kind="stable")
        self.rank = np.empty_like(order)  # place in the rising list
        np.put_along_axis(self.rank, order, np.arange(len(m))[:, None], axis=0)
        self.sorted = np.take_along_axis(m, order, axis=0)

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lists read to ``depth``, falling ones then rising ones: each candidate's value
        where its list has shown it, else the worst value (lower bounds) and the value
        reached (upper bounds)."""
        n = len(self.m)
        high, low = self.rank >= n - depth, self.rank < depth
        lower = np.hstack([np.where(high, self.m, self.sorted[0]), np.where(low, self.m, self.sorted[-1])])
        upper = np.hstack([np.where(high, self.m, self.sorted[n - depth]), np.where(low, self.m, self.sorted[depth - 1])])
        return lower, upper

    def survivors(self, q: np.ndarray, own: np.ndarray, k: int, bar: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(query's place, places of the candidates that can be among its k best), when
        reading stops for it.  ``own`` are the queries' ids, ``bar`` what the k-th best
        score has to reach."""
        n = len(self.m)
        sides = np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
        least = np.iinfo(np.int64).min if q.dtype == np.int64 else -np.inf
        going = np.arange(len(q))
        few = max(4 * k, n // 16)
        for share in DEPTHS:
            depth = max(1, int(n * share))
            lower_at, upper_at = self.bounds(depth)
            lower, upper = sides[going] @ lower_at.T, sides[going] @ upper_at.T
            mine = own[going][:, None] == self.ids
            lower[mine], upper[mine] = least, least
            reach = bar[going]
            if n > k:
                reach = np.maximum(reach, np.partition(lower, n - k, axis=1)[:, n - k])
            able = (upper >= reach[:, None]) & ~mine
            stop = (able.sum(axis=1) <= few) | (share == DEPTHS[-1])
            for at in np.flatnonzero(stop):
                yield int(going[at]), np.flatnonzero(able[at])
            going = going[~stop]
            if not len(going):
                return


def _best(parts: list[Lists], q: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, scores) of the k best over all parts, ties to smaller ids."""
    none = np.iinfo(np.int64).min if q.dtype == np.int64 else -np.inf
    bar = np.full(len(q), none, q.dtype)
    ids = [np.zeros(0, np.int64)] * len(q)
    scores = [np.zeros(0, q.dtype)] * len(q)
    for part in parts:
        for at, left in part.survivors(q, own, k, bar):
            if not len(left):
                continue
            x, s = np.concatenate([ids[at], part.ids[left]]), np.concatenate([scores[at], part.m[left] @ q[at]])  # resolve
            keep = np.lexsort((x, -s))[:k]
            ids[at], scores[at] = x[keep], s[keep]
            if len(keep) == k:
                bar[at] = s[keep[-1]]
    for at in range(len(q)):
        yield at, ids[at], scores[at]


def _matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    v = column.combine_chunks()
    sizes = v.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(v), width), kind)
    if len(v):
        out[np.repeat(np.arange(len(v)), sizes), np.concatenate([np.arange(n) for n in sizes])] = v.flatten().to_numpy()
    return out


def search(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``; ``queries`` is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col)
    most, width = rows.agg(F.max(F.array_max(F.transform("v", lambda c: F.greatest(c, -1 - c)))), F.max(F.size("v"))).first()
    most, width = (most or 0) + 1, width or 1
    if width * most * most >= 1 << 62:
        raise OverflowError(f"components up to {most} in {width} dimensions: scores could leave 64 bits")
    kind = np.float64 if width * most * most < 1 << 53 else np.int64
    narrow = "smallint" if most <= 1 << 15 else "int" if most <= 1 << 31 else "bigint"
    rows = written(rows.select("id", F.col("v").cast(f"array<{narrow}>").alias("v")), "topk-vectors")
    asked = rows.filter(queries).distinct()
    n, n_asked = rows.count(), asked.count()
    cell = min(CELL, max(LEAST_CELL, math.ceil(n / (4 * spark.sparkContext.defaultParallelism))))
    cells, blocks = max(1, math.ceil(n / cell)), max(1, math.ceil(n_asked / BLOCK))
    # Cells and blocks are dealt by a hash of the whole row, so that repeated ids spread too.
    side_c = rows.withColumn("cell", F.pmod(F.xxhash64("id", "v"), F.lit(cells)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    side_q = asked.withColumn("block", F.pmod(F.xxhash64("v", "id"), F.lit(blocks)).cast("int")).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))

    def run(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if c.num_rows and q.num_rows:
            c = c.sort_by("id")
            ids, m = c.column("id").to_numpy(), _matrix(c.column("v"), width, kind)
            parts = [Lists(ids[a : a + PART], m[a : a + PART]) for a in range(0, len(ids), PART)]
            own, asked_m = q.column("id").to_numpy(), _matrix(q.column("v"), width, kind)
            for a in range(0, len(own), TILE):
                for at, found, s in _best(parts, asked_m[a : a + TILE], own[a : a + TILE], k):
                    out.append((np.full(len(found), own[a + at]), found, s.astype(np.int64)))
        columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*out)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    parts = side_c.groupBy("block", "cell").cogroup(side_q.groupBy("block", "cell")).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
