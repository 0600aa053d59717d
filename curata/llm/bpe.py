"""Byte-level BPE encoding and decoding with a two-tier lookup.

A rank file (base64 token, rank per line) gives the vocabulary.  Whole
pre-tokens that are in it are resolved by a minimal perfect hash; the others
are merged by a heap over a linked list of bytes, lowest rank first, leftmost
on ties.  Documents are independent, so one map over the rows does it: no
shuffle, and a worker holds one batch, the vocabulary and a bounded memo.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, ident, python_ready

MEMO = 300_000                  # pre-tokens remembered by a worker before it starts afresh
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _slots(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ (d.astype(np.uint64) * _M1)) * _M2
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash over byte strings by hashing and displacing.

    Keys fall into buckets of four on average.  Buckets are placed from the
    largest down, each with the first displacement that sends its keys to free
    slots; a bucket of one key names its slot directly (stored as -slot - 1).
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.h = h = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, n)
        if n and len(np.unique(h)) != n:
            raise ValueError("repeated key or 64-bit hash collision")
        self.buckets = m = max(1, n // 4)
        self.shift = np.zeros(m, np.int64)
        self.key_at = np.full(n, -1, np.int64)
        of = (h % np.uint64(m)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(m + 1))
        sizes = np.diff(bounds)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[bounds[b]:bounds[b + 1]]
            if len(own) < 2:
                break
            at = 0
            while True:
                tries = np.arange(at, at + 64)
                s = _slots(h[own][None, :], tries[:, None], n)
                ok = free[s].all(axis=1)
                ok &= (np.diff(np.sort(s, axis=1), axis=1) > 0).all(axis=1)
                if ok.any():
                    k = int(ok.argmax())
                    self.shift[b] = at + k
                    free[s[k]] = False
                    self.key_at[s[k]] = own
                    break
                at += 64
        left = iter(np.flatnonzero(free))
        for b in np.flatnonzero(sizes == 1):
            s, own = int(next(left)), int(order[bounds[b]])
            self.shift[b] = -s - 1
            self.key_at[s] = own

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each byte string the index of the only key it can be, -1 if its hash differs."""
        if not self.n:
            return np.full(len(keys), -1, np.int64)
        h = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        s = np.where(d < 0, -d - 1, _slots(h, np.maximum(d, 0), self.n))
        at = self.key_at[s]
        return np.where(self.h[at] == h, at, -1)


class Codec:
    """Encoder and decoder for one vocabulary; pickles as its rank list."""

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str):
        self.tokens, self.ids, self.pattern = tokens, ids, pattern
        self.hash = PerfectHash(tokens)
        self._ready()

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("tokens", "ids", "pattern", "hash")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _ready(self):
        self.rank = dict(zip(self.tokens, self.ids))
        self.token_of = dict(zip(self.ids, self.tokens))
        self.byte_id = [self.rank.get(bytes([x])) for x in range(256)]
        self.text_of = {i: str(i) for i in self.ids}
        self.split = regex.compile(self.pattern).findall
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, b: bytes) -> tuple[int, ...]:
        """Merge the bytes of one pre-token: a heap of candidate pairs over a linked list."""
        n, rank = len(b), self.rank.get
        ids = [self.byte_id[x] for x in b]                                 # ids[i]: token of the piece that starts at i
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))     # after[i]: end of the piece at i; -1: merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(b[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i, end = heappop(heap)
            j = after[i]
            if j < 0 or j >= n or after[j] != end:
                continue                                                   # a neighbour has changed since
            ids[i], after[i], after[j] = r, end, -1
            if end < n:
                before[end] = i
                stop = after[end]
                if (r := rank(b[i:stop])) is not None:
                    heappush(heap, (r, i, stop))
            p = before[i]
            if p >= 0 and (r := rank(b[p:end])) is not None:
                heappush(heap, (r, p, end))
        out = tuple([t for t, e in zip(ids, after) if e > 0])
        if None in out:
            raise KeyError(f"the vocabulary lacks a byte of {b!r}")
        return out

    def learn(self, pieces: set[str]) -> None:
        """Fill the memo for new pre-tokens: perfect hash first, merges for the rest."""
        new = list(pieces.difference(self.memo))
        if not new:
            return
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(pieces)
        raw = [p.encode("utf-8") for p in new]
        for p, b, at in zip(new, raw, self.hash.find(raw)):
            whole = at >= 0 and self.tokens[at] == b
            self.memo[p] = (self.ids[at],) if whole else self.merge(b)

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        self.learn(set(pieces))
        return list(chain.from_iterable(map(self.memo.__getitem__, pieces)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Codec:
    """The codec of a rank file (read on the driver; a vocabulary is of fixed, small size)."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    return Codec([base64.b64decode(a) for a, _ in rows], [int(r) for _, r in rows], pattern)


def _mapped(docs: DataFrame, codec: Codec, kept: list[str], made: list[T.StructField], row) -> DataFrame:
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(codec)       # bounded by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            rows = [row(c, x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            cols = [pa.array([r[k] for r in rows], to_arrow(f.dataType)) for k, f in enumerate(made)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*batch.schema.names[:-1], *(f.name for f in made)])

    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), *made])
    return docs.mapInArrow(run, schema)


def to_arrow(kind):
    return {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
            "array<int>": pa.list_(pa.int32())}[kind.simpleString()]


def encode(docs: DataFrame, codec: Codec, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out`` (array<int>), the token ids of ``text``.

    A null text encodes as the empty text.  All columns of ``docs`` stay; one
    named like ``out`` is replaced.  Rows keep their number; empty in, empty out.
    """
    (tmp,) = fresh([*docs.columns, out], "text_in")
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    d = docs.select(*(ident(c) for c in kept), F.coalesce(ident(text), F.lit("")).alias(tmp))
    return _mapped(d, codec, kept, [T.StructField(out, T.ArrayType(T.IntegerType()))], lambda c, x: (c.encode(x),))


def decode(docs: DataFrame, codec: Codec, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out`` (binary), the bytes of the token ids; null ids give empty bytes."""
    (tmp,) = fresh([*docs.columns, out], "ids_in")
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    d = docs.select(*(ident(c) for c in kept), ident(ids).alias(tmp))
    return _mapped(d, codec, kept, [T.StructField(out, T.BinaryType())], lambda c, x: (c.decode(x or []),))


def round_trip(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode the ids again, and return digests instead of the long arrays.

    One row per input row (repeated rows stay): doc_id, n_tokens, ids_sha256
    (hex of the decimal ids joined by a space), decoded_sha256 (hex of the
    decoded bytes).  A null text counts as empty: no ids.
    """
    d = docs.select(ident(doc_id).alias("doc_id"), F.coalesce(ident(text), F.lit("")).alias("text"))
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType())]

    def row(c, x):
        ids = c.encode(x)
        shown = " ".join(map(c.text_of.__getitem__, ids)).encode("ascii")
        return len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()

    return _mapped(d, codec, ["doc_id"], made, row)
