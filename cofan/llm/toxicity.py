"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word's bag holds its hashed character n-grams (3 to 5, with word ends) and the
word itself; the mean of their embeddings goes through a linear softmax of two
classes.  A text's score is that of its most toxic word, so that one insult in a
long text is not averaged away, and an unseen misspelling shares n-gram vectors.
Embeddings and softmax are trained jointly in numpy (Adam), a text being toxic if
any of its words is (noisy or); clean texts teach all their words, toxic ones are
blamed on words of several training texts.  A word of fewer texts is blamed too if
it shares a character n-gram that as many toxic texts hold, relatively more often
than clean ones: a family of misspellings counts as one word.

Training takes about ``SAMPLE_ROWS`` labelled rows per class, by a hash of the
id (a documented bound), whole texts each; only their distinct words reach the
driver.  Without both classes every score is 0.

Null and empty texts, and texts without letters, score as a text without words:
0.  Repeated rows are scored each; an empty table gives an empty result; columns
other than id and text are never inputs of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import in_slices, texts

BUCKETS, DIM = 1 << 17, 8
SAMPLE_ROWS = 1200
#: A toxic text is blamed on words of so many training texts: a share of the toxic ones, 2 at least.
BLAME_SHARE = 0.015
FAMILY_RATIO = 3
WORD = regex.compile(r"[\p{L}\p{M}']+")
MAX_WORDS = 400_000  # words remembered per Python worker; beyond it the memory starts anew


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def bags(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every subword of every word."""
    marked = ["<" + w + ">" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(m) for m in marked])
    owner = np.repeat(np.arange(len(words)), size)
    left = np.cumsum(size)[owner] - np.arange(len(code)) if len(words) else np.zeros(0, int)  # code points to the word's end
    who = [np.arange(len(words))]
    where = [np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words], np.int64)]
    for n in (3, 4, 5):
        h = np.full(max(len(code) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = (h ^ code[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = left[: len(h)] >= n
        who.append(owner[: len(h)][inside])
        where.append((h[inside] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(who), np.concatenate(where)


class Model:
    """Embeddings ``e`` and softmax ``w`` (one column per class) with biases ``b``."""

    def __init__(self, e: np.ndarray, w: np.ndarray, b: np.ndarray) -> None:
        self.bucket, self.bias = (e @ (w[:, 1] - w[:, 0])).astype(np.float64), float(b[1] - b[0])
        self.known: dict[str, float] = {}

    def logits(self, words: list[str]) -> np.ndarray:
        who, where = bags(words)
        return np.bincount(who, self.bucket[where], len(words)) / np.bincount(who, minlength=len(words)) + self.bias

    def scores(self, batch: list[str]) -> np.ndarray:
        sets = [words_of(t) for t in batch]
        if len(self.known) > MAX_WORDS:
            self.known = {}
        new = sorted(set().union(*sets) - self.known.keys()) if sets else []
        for k in range(0, len(new), 50_000):
            self.known.update(zip(new[k : k + 50_000], self.logits(new[k : k + 50_000]).tolist()))
        worst = np.array([max(map(self.known.__getitem__, s), default=-np.inf) for s in sets])
        return 1 / (1 + np.exp(-np.maximum(worst, -700.0))) * (worst > -np.inf)


def _family(at: np.ndarray, doc: np.ndarray, who: np.ndarray, where: np.ndarray, buckets: int, y: np.ndarray, words: int) -> np.ndarray:
    """Whether a word shares an n-gram that enough toxic texts hold, at over
    ``FAMILY_RATIO`` times the rate of the clean ones."""
    by = np.argsort(who, kind="stable")
    grams, size = where[by], np.bincount(who, minlength=words)
    first = np.cumsum(size) - size
    held = np.zeros((2, buckets), np.int64)
    ends = np.searchsorted(doc, np.arange(len(y) + 1))
    for d, toxic in enumerate(y):
        own = at[ends[d] : ends[d + 1]]
        if len(own):
            got = np.unique(np.concatenate([grams[first[k] : first[k] + size[k]] for k in own]))
            held[int(toxic), got] += 1
    family = (held[1] >= max(2, BLAME_SHARE * y.sum())) & (held[1] * (~y).sum() > FAMILY_RATIO * held[0] * y.sum())
    return np.bincount(who, family[where], words) > 0


def train(docs: list[list[str]], toxic: list[int], seed: int = 11, steps: int = 120) -> Model:
    """Train on distinct words per text and 0/1 labels."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    w = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    b = np.array([0.0, -5.0], np.float32)
    y = np.array(toxic, bool)
    if not y.any() or y.all():
        return Model(np.zeros_like(e), w, np.array([0.0, -700.0]))
    index: dict[str, int] = {}
    at = np.array([index.setdefault(x, len(index)) for d in docs for x in d], np.int64)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    often = np.bincount(at, minlength=len(index)) >= max(2, BLAME_SHARE * y.sum())
    who, where = bags(list(index))
    used, where = np.unique(where, return_inverse=True)
    often |= _family(at, doc, who, where, len(used), y, len(index))
    keep = ~y[doc] | often[at]
    at, doc = at[keep], doc[keep]
    per = np.bincount(who, minlength=len(index)).astype(np.float64)
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum()) * len(y)
    slots = [e[used], w, b]
    m, v = [np.zeros_like(s) for s in slots], [np.zeros_like(s) for s in slots]
    for step in range(1, steps + 1):
        ee, ww, bb = slots
        u = ww[:, 1] - ww[:, 0]
        z = np.bincount(who, (ee @ u)[where], len(index)) / per + (bb[1] - bb[0])
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))[at]
        clean = np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(docs)))
        g = p * np.where(y, -clean / np.maximum(1 - clean, 1e-9), 1.0)[doc] * weight[doc]
        gz = np.bincount(at, g, len(index)) / len(docs)
        gs = np.bincount(where, (gz / per)[who], len(used))
        gu = (gs @ ee).astype(np.float32)
        grads = [np.outer(gs, u).astype(np.float32) + 1e-7 * ee, np.stack([-gu, gu], 1), np.array([-gz.sum(), gz.sum()], np.float32)]
        for s, d, mm, vv in zip(slots, grads, m, v):
            mm += 0.1 * (d - mm)
            vv += 0.01 * (d * d - vv)
            s -= 0.05 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
    whole = np.zeros((BUCKETS, DIM), np.float32)
    whole[used] = slots[0]
    return Model(whole, slots[1], slots[2])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the rows of ``docs`` that ``labels`` marks 0 or 1 (an id with
    several labels counts as toxic if one says so)."""
    said = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in said.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return train([], [])
    share = F.when(F.col("y") == 1, SAMPLE_ROWS / sizes[1]).otherwise(SAMPLE_ROWS / sizes[0])
    taken = said.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) < share)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(taken), "id").select("id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            sets = [sorted(words_of(t)) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("y"), pa.array(sets, pa.list_(pa.string()))], names=["id", "y", "words"])

    got = sorted((r["id"], r["y"], r["words"]) for r in rows.mapInArrow(run, "id string, y int, words array<string>").toArrow().to_pylist())
    return train([r[2] for r in got], [r[1] for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    kept = [f for f in docs.schema.fields if f.name != score_col]
    schema = T.StructType(kept + [T.StructField(score_col, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, text_col, 4 << 20):
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(shared.value.scores(texts(batch.column(text_col))))], names=schema.names)

    return docs.mapInArrow(run, schema)
