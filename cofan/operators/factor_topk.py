"""Exact top-k items of every user from factor tables, without scoring every pair.

Users are sorted by the direction of their factors (a Z-order key) and dealt into tiles
of at most ``TILE`` users of similar direction; one row holds a tile.  Scaled to L1 norm
1, a tile's users lie within ``r`` of their centre ``c``, so that for every ``m``
``u.v <= c.v + r.|v - m| + q |m|``, where ``q`` is the most that a user's sum differs from
the centre's; ``m`` is the median of ``v``.  Three passes:

1. every tile's ``SHORT`` best items for its centre, and from them for each user the k-th
   best score, which the user's k best items have to reach;
2. every item against the bounds of every tile: the items that can reach the least of
   its users' scores are the tile's candidates;
3. every user of a tile with every candidate, by blocks of at most about ``BLOCK`` items.

No item is left out that any of its users could rank among the k best, so the result is
that of scoring all pairs; directions that are spread or factors that are alike only make
more candidates.  The driver holds two small vectors a tile.  Ties go to the smaller item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofan.session import checkpoint_dir

TILE, SHORT = 512, 64
BLOCK = 1 << 18  # items of a block, about
TILES, ITEMS = 128, 1 << 13  # tiles, items at a time
SLACK = 1e-5  # rounding of float32 bounds, relative to the largest component


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel(), kind))


def _norms(u: np.ndarray) -> np.ndarray:
    n = np.abs(u).sum(axis=1, dtype=np.float64)
    return np.where(n > 0, n, 1.0)


def _directions(u: np.ndarray) -> np.ndarray:
    return u / _norms(u)[:, None]


def z_order(d: np.ndarray) -> np.ndarray:
    """The bits of the components (from -1 to 1), interleaved."""
    dims = min(d.shape[1], 20)
    bits = 60 // dims
    cells = ((np.clip(d[:, :dims], -1, 1) + 1) / 2 * ((1 << bits) - 1)).astype(np.int64)
    out = np.zeros(len(d), np.int64)
    for b in range(bits - 1, -1, -1):
        for j in range(dims):
            out = (out << 1) | ((cells[:, j] >> b) & 1)
    return out


def split(d: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the rows, halved along the widest dimension to parts of at most ``most``."""
    todo, done = [np.arange(len(d))], []
    while todo:
        i = todo.pop()
        if len(i) <= most:
            done.append(i)
            continue
        half = len(i) // 2
        order = i[np.argpartition(d[i, np.ptp(d[i], axis=0).argmax()], half)]
        todo += [order[:half], order[half:]]
    return done


def _tiles(users: DataFrame) -> DataFrame:
    """``tile, ids, features, c, r``: a row a tile, the features end to end."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("features"), pa.array(z_order(_directions(_matrix(b.column("features")))))], names=["id", "features", "z"])

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            ids, u = b.column("id").to_numpy(), _matrix(b.column("features"))
            d = _directions(u)
            for i in split(d, TILE):
                c = d[i].mean(axis=0)
                r = np.append(np.abs(d[i] - c).max(axis=0), np.abs(d[i].sum(axis=1) - c.sum()).max())
                yield pa.RecordBatch.from_arrays([pa.array([tile]), _lists(ids[i][None], pa.int32()), _lists(u[i].reshape(1, -1), pa.float32()), _lists(c[None], pa.float64()), _lists(r[None], pa.float64())], names=["tile", "ids", "features", "c", "r"])
                tile += 1

    z = users.select("id", "features").mapInArrow(keyed, "id int, features array<float>, z long")
    # The hash spreads users of one direction over partitions.
    near = z.repartitionByRange("z", F.xxhash64("id")).sortWithinPartitions("z").select("id", "features")
    # Checkpointed, so that a lost executor cannot deal the tiles anew.
    return near.mapInArrow(tiled, "tile long, ids array<int>, features array<float>, c array<double>, r array<double>").checkpoint(eager=True)


def _short_lists(items: DataFrame, tile: np.ndarray, c: np.ndarray) -> DataFrame:
    """``tile, shorts``: the factors of the ``SHORT`` best items for each tile's centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The best of the partition so far, per TILES tiles, not of each batch.
        score = [np.zeros((len(c[a : a + TILES]), 0)) for a in range(0, len(tile), TILES)]
        held = [np.zeros((*x.shape, c.shape[1]), np.float32) for x in score]
        for b in batches:
            v = _matrix(b.column("features")) if b.num_rows else ()
            for k in range(len(score) if len(v) else 0):
                s = c[k * TILES : (k + 1) * TILES] @ v.T
                n = min(SHORT, len(v))
                best = np.argpartition(-s, n - 1, axis=1)[:, :n]
                s = np.hstack([score[k], np.take_along_axis(s, best, axis=1)])
                f = np.concatenate([held[k], v[best]], axis=1)
                n = min(SHORT, s.shape[1])
                best = np.argpartition(-s, n - 1, axis=1)[:, :n]
                score[k], held[k] = np.take_along_axis(s, best, axis=1), np.take_along_axis(f, best[:, :, None], axis=1)
        for k, (s, f) in enumerate(zip(score, held)):
            if s.size:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(tile[k * TILES : (k + 1) * TILES], s.shape[1])), pa.array(s.ravel()), _lists(f.reshape(-1, f.shape[2]), pa.float32())], names=["tile", "score", "features"])

    found = items.mapInArrow(run, "tile long, score double, features array<float>")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("tile").orderBy(F.desc("score"))))
    return ranked.filter(F.col("rank") <= SHORT).groupBy("tile").agg(F.flatten(F.collect_list("features")).alias("shorts"))


def _barred(tiles: DataFrame, short: DataFrame, k: int) -> DataFrame:
    """``tile, ids, features, c, r, bars, least``: the score that each user's k best items
    have to reach, and the least of them at L1 norm 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                row = b.slice(j, 1)
                rank = len(row.column("c")[0])
                u, v = (row.column(x).flatten().to_numpy().astype(np.float64).reshape(-1, rank) for x in ("features", "shorts"))
                bars = np.full(len(u), -np.inf)
                if len(v) >= k:
                    s = u @ v.T
                    bars = np.partition(s, len(v) - k, axis=1)[:, len(v) - k] - 1e-9 * np.abs(s).max()
                least = (bars / _norms(u)).min()
                yield pa.RecordBatch.from_arrays([*(row.column(x) for x in ("tile", "ids", "features", "c", "r")), _lists(bars[None], pa.float64()), pa.array([least])], names=["tile", "ids", "features", "c", "r", "bars", "least"])

    out = "tile long, ids array<int>, features array<float>, c array<double>, r array<double>, bars array<double>, least double"
    return tiles.join(short, "tile").mapInArrow(run, out).checkpoint(eager=True)


def _candidates(items: DataFrame, blocks: int, tile: np.ndarray, c: np.ndarray, r: np.ndarray, least: np.ndarray) -> DataFrame:
    """``tile, block, ids, features``: the items that can reach a tile's least score, a row
    for those of a batch of items."""
    c, r = c.astype(np.float32), r.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() % blocks
        for b in batches:
            ids, v = b.column("id").to_numpy(), _matrix(b.column("features"))
            if not len(v):
                continue
            m = np.median(v, axis=1, keepdims=True)
            off = np.hstack([np.abs(v - m), np.abs(m)]).T
            slack = SLACK * np.abs(v).max()
            for a in range(0, len(tile), TILES):
                most = c[a : a + TILES] @ v.T + r[a : a + TILES] @ off
                at, j = np.nonzero(most >= (least[a : a + TILES] - slack)[:, None])
                some, sizes = np.unique(at, return_counts=True)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(tile[a + some]), pa.array(np.full(len(some), block, np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[j])), pa.ListArray.from_arrays(pa.array(ends * v.shape[1]), pa.array(v[j].ravel()))], names=["tile", "block", "ids", "features"])

    return items.mapInArrow(run, "tile long, block int, ids array<int>, features array<float>")


def _cut(at: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each user, ties to smaller ids."""
    order = np.lexsort((ids, -score, at))
    at, ids, score = at[order], ids[order], score[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < k
    return at[keep], ids[keep], score[keep]


def top_items(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """``userId, movieId, predicted_rating``: the ``k`` best items of every user (all, if
    fewer) from tables ``(id int, features array<float>)`` of one rank."""
    spark = users.sparkSession
    checkpoint_dir(spark)
    tiles = _tiles(users)
    head = tiles.select("tile", "c", "r").toArrow()
    schema = "userId int, movieId int, predicted_rating float"
    blocks = max(1, math.ceil(items.count() / BLOCK))
    if not head.num_rows:
        return spark.createDataFrame([], schema)
    dealt = items.select("id", "features").repartition(max(blocks, 2 * spark.sparkContext.defaultParallelism), "id")
    tile, c, r = head.column("tile").to_numpy(), _matrix(head.column("c")), _matrix(head.column("r"))
    barred = _barred(tiles, _short_lists(dealt, tile, c), k)
    bar = barred.select("tile", "least").toArrow().to_pydict()
    least = dict(zip(bar["tile"], bar["least"]))
    found = _candidates(dealt, blocks, tile, c, r, np.array([least.get(t, -np.inf) for t in tile.tolist()]))

    def best(own: pa.Table, others: pa.Table) -> pa.Table:
        at, got, score = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
        if own.num_rows and others.num_rows:
            ids, bars = (own.column(x).combine_chunks().flatten().to_numpy() for x in ("ids", "bars"))
            u = own.column("features").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
            theirs, v = (others.column(x).combine_chunks().flatten().to_numpy() for x in ("ids", "features"))
            v = v.reshape(len(theirs), -1)
            for a in range(0, len(theirs), ITEMS):
                s = u @ v[a : a + ITEMS].T.astype(np.float64)
                i, j = np.nonzero(s >= bars[:, None])
                at, got, score = _cut(*(np.concatenate(x) for x in ((at, i), (got, theirs[a + j]), (score, s[i, j].astype(np.float32)))), k)
            at = ids[at]
        return pa.table({"userId": pa.array(at, pa.int32()), "movieId": pa.array(got, pa.int32()), "predicted_rating": pa.array(score, pa.float32())})

    asked = barred.select("tile", "ids", "features", "bars").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    parts = asked.groupBy("tile", "block").cogroup(found.groupBy("tile", "block")).applyInArrow(best, schema)
    order = Window.partitionBy("userId").orderBy(F.desc("predicted_rating"), "movieId")
    return parts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= int(k)).drop("_rank")
