"""Language identification by prediction by partial matching.

Each language has a byte context tree of contexts up to ``ORDER`` bytes with
frozen counts.  A byte seen after its context in that language costs
``-log2(count / (total + distinct))``; otherwise the escape costs
``-log2(distinct / (total + distinct))`` and the next shorter context codes it,
down to a uniform byte.  A context unseen in the language costs nothing to leave.
The shortest code of the whole text names the language, ties to the smaller name;
the score is the posterior under equal priors.

The counts come from a sample of labelled rows: about ``SAMPLE_ROWS`` rows per
language, taken by a hash of the id, whole texts each (a documented bound); every
labelled language is learned.  Counting runs in Spark; contexts the
sample does not hold take the escape path, so every text gets its exact code
length.

Text that is null or has no letter is ``und`` with score 0; empty and very long
texts are scored whole; bytes that are not UTF-8 count as U+FFFD when scored;
without learned languages every text is ``und``.
Repeated rows are scored each; an empty table gives an empty result; columns
other than id and text are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import in_slices, text_bytes, texts

ORDER = 3
SAMPLE_ROWS = 150
UND = "und"
SLOTS = 1 << 20
WINDOWS = 1 << 20  # windows whose distinct ones are looked up at a time
CHUNK = 1 << 18  # windows summed at a time, times languages at a time
LANGS = 16  # languages at a time


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n-byte windows of ``data`` as integers, the last byte lowest."""
    out = np.zeros(max(len(data) - n + 1, 0), np.uint32)
    for k in range(n):
        out <<= np.uint32(8)
        out |= data[k : len(data) - n + 1 + k]
    return out


def count_grams(rows: DataFrame) -> DataFrame:
    """``lang, n, gram, seen`` from rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            texts = text_bytes(batch.column("text"))
            for lang in sorted(set(langs)):
                for n in range(1, ORDER + 2):
                    own = [grams(np.frombuffer(t, np.uint8), n) for t, x in zip(texts, langs) if x == lang]
                    g, c = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(np.full(len(g), n), pa.int32()), pa.array(g.astype(np.int64)), pa.array(c.astype(np.int64))], names=["lang", "n", "gram", "seen"])

    return rows.mapInArrow(run, "lang string, n int, gram long, seen long").groupBy("lang", "n", "gram").agg(F.sum("seen").alias("seen"))


class Sparse:
    """Counts by (key, language), those that are not zero only."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, seen: np.ndarray) -> None:
        order = np.lexsort((lang, key))
        self.keys, starts = np.unique(key[order], return_index=True)
        self.starts = np.append(starts, len(order)).astype(np.int64)
        self.lang, self.seen = lang[order].astype(np.int32), seen[order].astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted key, -1 where it is absent."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def dense(self, at: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Counts of the keys at the places ``at`` under languages ``lo`` to ``hi``."""
        out = np.zeros((len(at), hi - lo))
        rows = np.flatnonzero(at >= 0)
        first = self.starts[at[rows]]
        sizes = self.starts[at[rows] + 1] - first
        entry = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        row, lang = np.repeat(rows, sizes), self.lang[entry]
        own = (lang >= lo) & (lang < hi)
        out[row[own], lang[own] - lo] = self.seen[entry[own]]
        return out


class Ppm:
    """Frozen code lengths of all languages.  Memory follows the windows that each
    language's sample holds, not windows times languages."""

    def __init__(self, counts: pa.Table) -> None:
        self.langs: list[str] = sorted(set(counts.column("lang").to_pylist()))
        lang = np.searchsorted(np.array(self.langs, dtype=object), np.array(counts.column("lang").to_pylist(), dtype=object)) if self.langs else np.zeros(0, int)
        n, gram, seen = (counts.column(c).to_numpy() for c in ("n", "gram", "seen"))
        width = max(len(self.langs), 1)
        self.grams: list[Sparse] = []
        self.contexts: list[tuple[Sparse, Sparse]] = []  # bytes seen after a context, and how many different ones
        for size in range(1, ORDER + 2):
            own = n == size
            self.grams.append(Sparse(gram[own], lang[own], seen[own]))
            pair, of = np.unique((gram[own] >> 8) * width + lang[own], return_inverse=True)
            total = np.bincount(of, seen[own], len(pair))
            self.contexts.append(tuple(Sparse(pair // width, pair % width, c) for c in (total, np.bincount(of, minlength=len(pair)))))
        self.index = None

    def bits(self, gram: np.ndarray, order: int, lo: int, hi: int) -> np.ndarray:
        """Code length, under languages ``lo`` to ``hi``, of the last byte of each
        window after the ``order`` bytes before it."""
        cost = np.zeros((len(gram), hi - lo))
        open_ = np.ones(cost.shape, bool)
        for k in range(order, -1, -1):
            g = gram & ((1 << 8 * (k + 1)) - 1)
            total, kinds = self.contexts[k]
            ctx = total.find(g >> 8)
            count, t, d = self.grams[k].dense(self.grams[k].find(g), lo, hi), total.dense(ctx, lo, hi), kinds.dense(ctx, lo, hi)
            there = open_ & (count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost += np.where(there, np.log2((t + d) / count), 0)
                cost += np.where(open_ & (count == 0) & (t > 0), np.log2((t + d) / d), 0)
            open_ &= count == 0
        return cost + 8.0 * open_

    def _build(self) -> None:
        """A table, found by a hash, of the places of the sample's windows."""
        keys = self.grams[ORDER].keys
        self.index = np.full(SLOTS, len(keys), np.int32)
        self.index[self._slot(keys.astype(np.uint32))] = np.arange(len(keys), dtype=np.int32)
        self.keys32 = np.append(keys, 0).astype(np.uint32)

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return (g * np.uint32(2654435761)) >> np.uint32(12)

    def _distinct(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct windows of ``g`` and the place of each window among them.
        Windows outside the table, or whose slot another holds, are sorted."""
        at = self.index[self._slot(g)]
        right = (self.keys32[at] == g) & (at < len(self.keys32) - 1)
        used = np.zeros(len(self.keys32), bool)
        used[at[right]] = True
        place = np.cumsum(used, dtype=np.int32) - np.int32(1)
        odd, back = np.unique(g[~right], return_inverse=True)
        of = np.where(right, place[at], np.int32(0))
        of[~right] = used.sum() + back
        return np.concatenate([self.keys32[used], odd]).astype(np.int64), of

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        if self.index is None:
            self._build()
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        out = np.zeros((len(texts), len(self.langs)))
        for j in range(ORDER):  # the first bytes have shorter contexts
            own = np.flatnonzero(sizes > j)
            if len(own):
                gram = sum(data[starts[own] + i].astype(np.int64) << 8 * (j - i) for i in range(j + 1))
                for lo, hi in self._blocks():
                    out[own, lo:hi] += self.bits(gram, j, lo, hi)
        last = np.maximum(ends - ORDER, starts)  # windows of a text start before this
        part = max(CHUNK // min(len(self.langs), LANGS), 1)
        for c in range(0, len(data) - ORDER, WINDOWS):
            windows, of = self._distinct(grams(data[c : c + WINDOWS + ORDER], ORDER + 1))
            for lo, hi in self._blocks():
                bits = self.bits(windows, ORDER, lo, hi)
                for p in range(0, len(of), part):
                    own = of[p : p + part]
                    # The texts that hold some of these windows.
                    a, b = np.searchsorted(ends, c + p, "right"), np.searchsorted(starts, c + p + len(own))
                    sums = np.zeros((len(own) + 1, hi - lo))
                    np.cumsum(bits[own], axis=0, out=sums[1:])
                    ends_at, starts_at = (np.clip(x[a:b] - (c + p), 0, len(own)) for x in (last, starts))
                    out[a:b, lo:hi] += sums[ends_at] - sums[starts_at]
        return out

    def _blocks(self) -> list[tuple[int, int]]:
        """Languages scored at a time."""
        return [(lo, min(lo + LANGS, len(self.langs))) for lo in range(0, len(self.langs), LANGS)]


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Ppm:
    """Learn from rows with a non-null language."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    share = rows.groupBy("lang").agg((F.lit(SAMPLE_ROWS) / F.count("*")).alias("share"))  # one row a language
    taken = rows.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) < F.col("share")).select("lang", "text")
    return Ppm(count_grams(taken).toArrow())


def predict(docs: DataFrame, model: Ppm, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    kept = [f for f in docs.schema.fields if f.name not in (pred_col, score_col)]
    schema = T.StructType(kept + [T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        for batch in in_slices(batches, text_col, 2 << 20):
            values = texts(batch.column(text_col))
            some = [k for k, t in enumerate(values) if any(map(str.isalpha, t))] if ppm.langs else []
            names: list[str] = [UND] * len(values)
            scores = np.zeros(len(values))
            if some:
                bits = ppm.lengths([values[k].encode("utf-8") for k in some])
                best = bits.argmin(axis=1)
                odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0))
                scores[some] = 1 / odds.sum(axis=1)
                for k, b in zip(some, best):
                    names[k] = ppm.langs[b]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(names, pa.string()), pa.array(scores)], names=schema.names)

    return docs.mapInArrow(run, schema)
