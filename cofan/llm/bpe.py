"""Byte-pair encoding and decoding with a public vocabulary file.

The method is a contiguous rank array: for each word, the part boundaries and
the ranks of adjacent pairs are held in two lists; the smallest rank is found by
a scan, its inner boundary is deleted and the two neighbouring ranks are
refreshed.  Words longer than ``LONG_WORD`` symbols, where repeated scans would
cost the square of the length, keep the same boundaries and ranks in a heap and
give the same parts.

The pre-processing is what the vocabulary file states: special strings are cut
out first, the rest is NFC-normalised, runs of white space become one space,
letters are lower-cased one by one, the pattern's matches are the words, and a
word's UTF-8 bytes are its symbols, the last one with the end-of-word mark.

Null text counts as empty; an empty text has no ids and decodes to the empty
text; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import in_slices, texts

LONG_WORD = 128
#: Distinct words remembered per Python worker; beyond it the memory starts anew.
MAX_WORDS = 400_000


def byte_symbols() -> list[str]:
    """Printable bytes stand for themselves; the others take code points from
    256 upwards, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file (``word_bpe_49k.json``'s kind)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = _tokens(spec)
        self.token_array = pa.array(self.tokens, pa.string())
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find_words = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.marks = {s[0] for s in self.special}  # what a special string begins with
        self.white = regex.compile(r"\s+")
        self.symbols = byte_symbols()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # word -> row of the stored parts
        self.starts, self.stored = [0], []

    # ---- one word --------------------------------------------------------

    def parts(self, word: str) -> list[str]:
        """The parts of one word by the contiguous rank array."""
        symbols = [self.symbols[b] for b in word.encode("utf-8")]
        symbols[-1] += self.end
        if len(symbols) > LONG_WORD:
            return self._parts_long(symbols)
        none = len(self.ranks)
        rank_of = self.ranks.get
        joined = symbols  # part k lies between boundaries k and k + 1
        ranks = [rank_of(pair, none) for pair in zip(joined, joined[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            joined[k : k + 2] = [joined[k] + joined[k + 1]]  # the boundary between them goes
            del ranks[k]
            if k:
                ranks[k - 1] = rank_of((joined[k - 1], joined[k]), none)
            if k < len(ranks):
                ranks[k] = rank_of((joined[k], joined[k + 1]), none)
        return joined

    def _parts_long(self, part: list[str]) -> list[str]:
        """The same parts, the smallest rank taken from a heap (rank, position)."""
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, k, part[k], part[k + 1]) for k in range(n - 1) if (r := self.ranks.get((part[k], part[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, left, right = heapq.heappop(heap)
            j = after[k] if alive[k] else n
            if j >= n or part[k] != left or part[j] != right:
                continue  # a neighbour has changed since
            part[k], alive[j], after[k] = left + right, False, after[j]
            if after[k] < n:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] < n and (r := self.ranks.get((part[a], part[after[a]]))) is not None:
                    heapq.heappush(heap, (r, a, part[a], part[after[a]]))
        return [p for p, a in zip(part, alive) if a]

    # ---- texts -----------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = self.white.sub(" ", text)
        # str.lower knows one rule that depends on the neighbours: the final sigma.
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def _learn(self, words: list[str], special: bool) -> None:
        for w in words:
            key = "\0" + w if special else w  # a match of the pattern never holds both
            if key not in self.known:
                self.known[key] = len(self.starts) - 1
                self.stored += [self.special[w]] if special else [self.vocab[p] for p in self.parts(w)]
                self.starts.append(len(self.stored))

    def encode_batch(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts, end to end."""
        if len(self.known) > MAX_WORDS:
            self._forget()
        rows: list[list[int]] = []
        for text in batch:
            out: list[int] = []
            for piece in self.cut.split(text) if self.cut and any(m in text for m in self.marks) else (text,):
                special = piece in self.special
                words = ["\0" + piece] if special else self.find_words(self.normalise(piece))
                try:
                    out += [self.known[w] for w in words]
                except KeyError:
                    self._learn([piece] if special else words, special)
                    out += [self.known[w] for w in words]
            rows.append(out)
        starts, stored = np.array(self.starts, np.int64), np.array(self.stored, np.int32)
        flat = np.fromiter((k for r in rows for k in r), np.int64, sum(map(len, rows)))
        sizes = starts[flat + 1] - starts[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(starts[flat], sizes)
        bounds = np.cumsum([0, *map(len, rows)])
        offsets = np.concatenate([[0], ends])[bounds]
        return offsets.astype(np.int32), stored[index]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[1].tolist()


def decode_lists(tokens: pa.Array, ids: pa.ListArray) -> pa.Array:
    """Token strings joined by one space: the file names no decoder."""
    flat = ids.flatten()
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens.take(flat)), " ")


def _tokens(spec: dict) -> list[str]:
    ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    out = [""] * (1 + max(ids.values()))
    for token, k in [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
        out[k] = token
    return out


@lru_cache(maxsize=2)
def token_strings(path: str) -> pa.Array:
    """The token strings of a file by id."""
    with open(path, encoding="utf-8") as f:
        return pa.array(_tokens(json.load(f)), pa.string())


@lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    """The model of a file, once per Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` and the token ids of each whole text.  ``vocabulary`` is a path
    that every executor has (an installed package's file)."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != ids_col] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    rest = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary)
        for batch in in_slices(batches, text_col, 4 << 20):
            offsets, ids = bpe.encode_batch(texts(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` and the text that each id list decodes to (null: empty).  Only the
    token strings are loaded."""
    schema = T.StructType([f for f in encoded.schema.fields if f.name != out_col] + [T.StructField(out_col, T.StringType())])
    rest = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_strings(vocabulary)
        for batch in batches:
            for piece in in_slices(iter([batch]), ids_col, 16 << 20):
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), decode_lists(tokens, piece.column(ids_col))], names=schema.names)

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document: encoded and
    decoded in one step, so that a task has one Python worker and one model."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary)
        for batch in in_slices(batches, "text", 2 << 20):
            offsets, ids = bpe.encode_batch(texts(batch.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids).cast(pa.string())), " ")
            sha = lambda column: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), sha(shown), sha(decode_lists(bpe.token_array, lists))], names=schema.names)

    return rows.mapInArrow(run, schema)
