r"""Runs of repeated words by online catching of squares over dyadic blocks.

A run is a longest stretch of words ``[^\x20\x09-\x0D]+`` with smallest period q
(words q apart are identical) of at least ``max(MIN_WORDS, MIN_PERIODS * q)`` words.

On level k the text is cut into blocks of B = 2^k words.  When a block that begins
at word s is complete, its catcher waits for the block's copies that begin at words
s + B to s + 2B - 1, that is for periods from B up to 2B.  So each word that is
appended has one catcher a level to serve: the suffix of B words that ends there is
compared with the catcher's block.  The comparison advances from level to level: a
suffix of 2B words has the fingerprint of its two halves.  A stretch of period p with
three or more periods holds a whole block and its copy, so no run escapes.

Catches of neighbouring blocks with one period are one stretch; words themselves,
not fingerprints, are then compared outward from it.  Two whole periods are a square,
and squares merge into the run that contains them: a catch inside a run of a smaller
period that an earlier level found is part of that run and needs no comparison.

All texts of an Arrow slice advance together, level by level; longer texts come
first, so that higher levels touch them only.  A level costs a fixed number of array
operations over its words, and each stretch a comparison as far as it reaches.

A word of a run after the run's first q words is a repetition; ``collapsed`` holds
the other words, joined by one space.  Null and empty texts and texts without words
have no runs and collapse to the empty text; repeated rows are read each; an empty
table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import in_slices, text_bytes

MIN_WORDS, MIN_PERIODS = 6, 4
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * _M1) ^ (right + (left >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(31))


def _reach(x: np.ndarray, at: int, period: int, stop: int, step: int) -> int:
    """How many words from ``at`` on, up to ``stop`` (left out), equal the words one
    period to the right; compared in growing pieces."""
    done, size = 0, 32
    left = abs(stop - at)
    while done < left:
        piece = min(size, left - done)
        lo = at + done if step > 0 else at - done - piece + 1
        differ = np.flatnonzero(x[lo : lo + piece] != x[lo + period : lo + period + piece])
        if len(differ):
            return done + int(differ[0] if step > 0 else piece - 1 - differ[-1])
        done, size = done + piece, size * 4
    return done


def _inside(start: np.ndarray, end: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which stretches lie inside one of ``runs`` (start, end, ...)."""
    if not len(runs):
        return np.zeros(len(start), bool)
    by = np.argsort(runs[:, 0], kind="stable")
    furthest = np.maximum.accumulate(runs[by, 1])
    at = np.searchsorted(runs[by, 0], start, "right") - 1
    return (at >= 0) & (furthest[at] >= end)


def _equal(x: np.ndarray, stretches: Iterator[tuple[int, int, int]], size: int) -> Iterator[tuple[int, int, int]]:
    """The stretches whose words equal those one period on; of a stretch in which
    two fingerprints met by chance, the blocks that do."""
    for b, e, p in stretches:
        if np.array_equal(x[b:e], x[b + p : e + p]):
            yield b, e, p
        else:
            yield from ((s, s + size, p) for s in range(b, e, size) if np.array_equal(x[s : s + size], x[s + p : s + size + p]))


def squares(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, end, period) of the stretches of two or more smallest periods that
    catchers find in the word numbers ``x``; text k is ``x[starts[k]:ends[k]]`` and texts
    come by falling length, parted by numbers that occur once.  Every such stretch
    of three periods or more is among them."""
    runs = np.zeros((0, 3), np.int64)
    prints = x.astype(np.uint64)
    size = 1  # B
    while True:
        n_texts = int(np.searchsorted(-(ends - starts), -3 * size, "right"))
        if not n_texts:
            return runs
        # Suffix starts t that have a full suffix and a catcher before it.
        stop = int(ends[n_texts - 1]) - size + 1
        prints = prints[:stop]
        t = np.arange(size, stop)
        block = (t // size - 1) * size
        hit = np.flatnonzero(prints[t] == prints[block])
        t, block = t[hit], block[hit]
        new = ~_inside(block, t + size, runs)
        t, block = t[new], block[new]
        if len(t):
            period = t - block
            by = np.lexsort((block, period))
            block, period = block[by], period[by]
            first = np.concatenate([[True], (period[1:] != period[:-1]) | (block[1:] != block[:-1] + size)])
            last = np.concatenate([np.flatnonzero(first)[1:] - 1, [len(block) - 1]])
            found = []
            stretches = zip(block[first].tolist(), (block[last] + size).tolist(), period[first].tolist())
            for b, e, p in _equal(x, stretches, size):
                k = int(np.searchsorted(starts, b, "right")) - 1
                lo = b - _reach(x, b - 1, p, int(starts[k]) - 1, -1)
                hi = e + _reach(x, e, p, int(ends[k]) - p, 1) + p
                if hi - lo >= 2 * p:
                    found.append((lo, hi, p))
            if found:
                runs = np.concatenate([runs, np.unique(np.array(found, np.int64), axis=0)])
        if len(prints) <= size:
            return runs
        prints = _mixed(prints[:-size], prints[size:])
        size *= 2


def find_batch(batch: list[bytes]) -> list[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """For each text its runs (start, length, period), by start and period, and
    the words that are left."""
    words = [t.split() for t in batch]  # splits at exactly [\x20\x09-\x0D]
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    number: dict[bytes, int] = {}
    flat = np.empty(sum(map(len, words)) + len(words), np.int64)
    starts, ends = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    at = 0
    for place, k in enumerate(order):
        own = words[k]
        starts[place], ends[place] = at, at + len(own)
        flat[at : at + len(own)] = [number.setdefault(w, len(number)) for w in own]
        flat[at + len(own)] = -1 - place  # parts the texts
        at += len(own) + 1
    found = squares(flat, starts, ends)
    length = found[:, 1] - found[:, 0]
    found = found[length >= np.maximum(MIN_WORDS, MIN_PERIODS * found[:, 2])]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    of = np.searchsorted(starts, found[:, 0], "right") - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for place, (lo, hi, p) in zip(of.tolist(), found.tolist()):
        runs[order[place]].append((lo - int(starts[place]), hi - lo, p))
    out = []
    for own, got in zip(words, runs):
        if got:
            gone = np.zeros(len(own) + 1, np.int64)
            for start, size, p in got:
                gone[start + p] += 1
                gone[start + size] -= 1
            own = [w for w, g in zip(own, np.cumsum(gone)) if not g]
        out.append((got, own))
    return out


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, and ``n_words``, ``runs`` (array of start,
    length, period) and ``collapsed`` of every whole text."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.BinaryType())]
    kept = [f for f in docs.schema.fields if f.name != text_col and f.name not in {a.name for a in added}]
    rest = [f.name for f in kept]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, text_col):
            raw = text_bytes(batch.column(text_col))
            got = find_batch(raw)
            columns = [
                pa.array([len(t.split()) if r else len(own) for t, (r, own) in zip(raw, got)], pa.int64()),
                pa.array([[dict(zip(RUN.names, x)) for x in r] for r, _ in got], kind),
                pa.array([b" ".join(own) for _, own in got], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], names=[*rest, *(a.name for a in added)])

    schema = T.StructType(kept + added)
    return docs.select(*rest, text_col).mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
