"""Scoring texts with a deleted-interpolation word model.

P(w | v) mixes the maximum-likelihood estimates of bigram, unigram and the
uniform distribution.  The weights depend on how often the context v occurs
(one bucket per power of two) and are learned by expectation-maximisation on
counts from which the document at hand is deleted, over all learning documents.

Layout: texts are cut into blocks of about half a million tokens, each with
its word hashes and its token stream as compressed indices into them.  A block asks
for the corpus counts of its different words and bigrams by shards of the
64-bit hash range; a shard adds up what all blocks send and answers only where
the total differs from what the block already knows.  So an n-gram travels
once per block and not once per occurrence, no task holds more than a shard or
a block, and a frequent n-gram is one entry per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_fold, ident, python_ready, written

BLOCK_TOKENS = 1 << 19
SHARD_ENTRIES = 1 << 21
END = np.uint64(xxhash.xxh64_intdigest(b""))      # the end token: no word is empty
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

BLOCK = "block long, ids array<long>, learn array<boolean>, held array<boolean>, sizes array<int>, words binary, stream binary, entries long"
REQUEST = "shard long, kind int, block long, n int, packed binary, counts binary"
REPLY = "block long, kind int, shard long, answer binary, total long, kinds long"


def _small_ints(a: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that fits, its width in the first byte."""
    top = int(a.max()) if len(a) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + a.astype(f"<u{width}").tobytes()


def _ints(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


def _stream(a: np.ndarray) -> bytes:
    """Token indices, byte plane by byte plane, compressed: words are numbered
    as they come up, so the high planes are nearly empty."""
    return zlib.compress(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unstream(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, in as many bytes as the largest needs."""
    d = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    first, d = d[:1].copy(), d.copy()
    d[:1] = 0
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([width]) + first.tobytes() + d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    width = b[0]
    if len(b) == 1:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(b, "<u8", 1, 1)
    body = np.frombuffer(b, np.uint8, offset=9).reshape(-1, width)
    d = np.zeros((len(body), 8), np.uint8)
    d[:, :width] = body
    d = d.view("<u8").ravel().copy()
    d[0] = first[0]
    return np.cumsum(d, dtype=np.uint64)


def _block_row(number: int, docs: list, at: dict) -> list:
    ids, learn, held, streams = zip(*docs)
    words = np.fromiter((xxhash.xxh64_intdigest(w) for w in at), np.uint64, len(at))
    stream = np.concatenate(streams)
    return [number, list(ids), list(learn), list(held), [len(s) for s in streams], words.tobytes(),
            _stream(stream), len(words) + len(stream)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in BLOCK.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
             pa.binary(), pa.binary(), pa.int64()]
    number = TaskContext.get().partitionId() << 24

    def row(values):
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    docs, at, tokens = [], {b"": 0}, 0
    for batch in batches:
        for doc_id, text, learn, held in zip(*(c.to_pylist() for c in batch.columns)):
            # bytes: lower() folds A-Z and split() cuts at ASCII white space only
            stream = [at.setdefault(w, len(at)) for w in (text or "").encode("utf-8").lower().split()]
            stream.append(0)
            docs.append((doc_id, learn, held, np.array(stream, np.int32)))
            tokens += len(stream)
            if tokens >= BLOCK_TOKENS:
                yield row(_block_row(number, docs, at))
                docs, at, tokens, number = [], {b"": 0}, 0, number + 1
    if docs:
        yield row(_block_row(number, docs, at))


class Block:
    """A block's arrays: tokens, their contexts, and the bigram types in key order."""

    def __init__(self, r):
        words = np.frombuffer(r["words"], np.uint64)
        order = np.argsort(words)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words, self.stream = words[order], rank[_unstream(r["stream"])]
        self.sizes = np.array(r["sizes"], np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.learns = np.repeat(np.array(r["learn"], bool), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.context = np.empty_like(self.stream)
        self.context[1:] = self.stream[:-1]
        self.context[starts] = np.searchsorted(self.words, END)
        n = len(self.words)
        types, inv = np.unique(self.context * n + self.stream, return_inverse=True)
        with np.errstate(over="ignore"):
            keys = (self.words[types // n] * _M1) ^ ((self.words[types % n] + _M1) * _M2)
            keys = (keys ^ (keys >> np.uint64(29))) * _M1
        order = np.argsort(keys)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pairs, self.pair = keys[order], place[inv]           # type keys, and each token's type
        self.own_word = np.bincount(self.stream[self.learns], minlength=n)
        self.own_pair = np.bincount(self.pair[self.learns], minlength=len(keys))

    def requests(self, bits: int):
        """(kind, shard, keys, own counts) for every shard that the block needs."""
        for kind, keys, own in ((0, self.words, self.own_word), (1, self.pairs, self.own_pair)):
            shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            cuts = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                yield kind, int(shard[a]), keys[a:b], own[a:b]


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = [(s, k, r["block"], len(keys), _pack(keys), _small_ints(own)) for k, s, keys, own in Block(r).requests(bits)]
                cols = zip(*rows)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["shard", "kind", "block", "n", "packed", "counts"])
    return run


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Add up one shard; answer each block, 0 where it already knows the total."""
    shard, kind = int(key[0]), int(key[1])
    keys = np.concatenate([_unpack(b) for b in rows["packed"]])
    own = np.concatenate([_ints(b) for b in rows["counts"]])
    _, inv = np.unique(keys, return_inverse=True)
    total = np.bincount(inv, weights=own).astype(np.int64)
    answer = np.where(total[inv] == own, 0, total[inv])
    ends = np.cumsum(rows["n"].to_numpy())
    out = [(int(b), kind, shard, zlib.compress(_small_ints(answer[e - n:e]), 1), None, None)
           for b, n, e in zip(rows["block"], rows["n"], ends)]
    out.append((-1, kind, shard, b"", int(total.sum()), int((total > 0).sum())))
    return pd.DataFrame(out, columns=["block", "kind", "shard", "answer", "total", "kinds"])


def _counts(block: Block, replies: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts of the block's words and bigram types."""
    out = []
    for kind, own in ((0, block.own_word), (1, block.own_pair)):
        mine = replies[replies["kind"] == kind].sort_values("shard")
        told = np.concatenate([_ints(zlib.decompress(b)) for b in mine["answer"]])
        out.append(np.where(told == 0, own, told))
    return out[0], out[1]


def _mixed(c12, c1, c2, total: float):
    """(bucket, bigram estimate, unigram estimate) from counts."""
    bucket = np.where(c1 > 0, np.log2(np.maximum(c1, 1)).astype(np.int64) + 1, 0)
    return bucket, np.where(c1 > 0, c12 / np.maximum(c1, 1), 0.0), np.where(total > 0, c2 / max(total, 1.0), 0.0)


CELL = "bucket int, two int, one int, n long, p2 double, p1 double"


def _cells(total: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({c.split()[0]: [] for c in CELL.split(", ")})
        if not len(left):
            return out
        b = Block(left.iloc[0])
        if not b.learns.any():
            return out
        words, pairs = _counts(b, right)

        def less(corpus, of, width):
            """Counts of the tokens' items without those in the token's own document."""
            code = b.doc * width + of
            kinds, inv, n = np.unique(code, return_inverse=True, return_counts=True)
            return corpus[of] - n[inv]
        c12 = less(pairs, b.pair, len(b.pairs))
        c2 = less(words, b.stream, len(b.words))
        c1 = less(words, b.context, len(b.words))
        rest = np.repeat(total - b.sizes, b.sizes)
        bucket, p2, p1 = _mixed(c12, c1, c2, 1.0)
        p1 = np.where(rest > 0, c2 / np.maximum(rest, 1), 0.0)
        on = b.learns
        level = [np.where(p > 0, np.round(2 * np.log2(np.maximum(p, 1e-300))), -9999).astype(int)[on] for p in (p2, p1)]
        cell = pd.DataFrame({"bucket": bucket[on], "two": level[0], "one": level[1], "n": 1, "p2": p2[on], "p1": p1[on]})
        return cell.groupby(["bucket", "two", "one"], as_index=False).sum()
    return run


def learn_weights(cells: pd.DataFrame, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per bucket by expectation-maximisation
    over cells of tokens with nearly equal estimates (p2, p1: sums over n tokens).
    A bucket without data takes the weights of the next one below."""
    out = np.tile(np.array([0.0, 0.9, 0.1]), (65, 1))
    for k in range(65):
        own = cells[cells["bucket"] == k]
        if not len(own):
            out[k] = out[k - 1] if k else out[k]
            continue
        n = own["n"].to_numpy(float)
        p = np.stack([own["p2"].to_numpy() / n, own["p1"].to_numpy() / n, np.full(len(own), uniform)], axis=1)
        w = np.array([1 / 3, 1 / 3, 1 / 3]) if k else np.array([0.0, 0.5, 0.5])
        for _ in range(rounds):
            part = p * w
            w = (n[:, None] * part / part.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            w = np.maximum(w, [0.0, 1e-6, 1e-6])
            w /= w.sum()
        out[k] = w
    return out


SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(weights: np.ndarray, total: int, kinds: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in SCORE.split(", ")]
        if not len(left):
            return pd.DataFrame({c: [] for c in names})
        r = left.iloc[0]
        b = Block(r)
        words, pairs = _counts(b, right)
        c2 = words[b.stream]
        bucket, p2, p1 = _mixed(pairs[b.pair], words[b.context], c2, float(total))
        w = weights[bucket]
        mine = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (kinds + 1))
        base = np.log10((c2 + 0.5) / (total + 0.5 * (kinds + 1)))
        n = len(b.sizes)
        return pd.DataFrame({
            "doc_id": pd.array([None if x is None or x != x else int(x) for x in r["ids"]], dtype="Int64"), "held_out": list(r["held"]),
            "n_tokens": b.sizes, "n_known": np.bincount(b.doc, weights=c2 > 0, minlength=n).astype(np.int64),
            "train_tokens": total, "base_score": np.bincount(b.doc, weights=base, minlength=n),
            "score": np.bincount(b.doc, weights=mine, minlength=n)})[names]
    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (log10 probabilities of the whole text).

    Documents whose crc32(id) modulo ``folds`` is ``fold`` are held out and
    teach nothing.  A null text is empty: its end token only.  Without any
    learning document all estimates but the uniform one are zero.
    """
    spark = docs.sparkSession
    python_ready(spark)
    held = hash_fold(ident(doc_id), folds) == fold
    d = docs.select(ident(doc_id).cast("long").alias("doc_id"), ident(text).alias("text"), (~held).alias("learn"), held.alias("held"))
    blocks = written(d.mapInArrow(_blocks, BLOCK), "lm-blocks")
    entries = blocks.agg(F.sum("entries")).first()[0] or 0
    bits = max(0, int(entries // SHARD_ENTRIES).bit_length())
    asked = blocks.mapInArrow(_ask(bits), REQUEST)
    replies = written(asked.groupBy("shard", "kind").applyInPandas(_answer, REPLY), "lm-replies")
    total, kinds = replies.where("block = -1 AND kind = 0").agg(F.sum("total"), F.sum("kinds")).first()
    total, kinds = int(total or 0), int(kinds or 0)
    both = blocks.groupBy("block").cogroup(replies.where("block >= 0").select("block", "kind", "shard", "answer").groupBy("block"))
    cells = both.applyInPandas(_cells(total), CELL).groupBy("bucket", "two", "one").agg(
        F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1"))
    cells = cells.toPandas().sort_values(["bucket", "two", "one"])          # a grid of estimates: bounded, whatever the input
    weights = learn_weights(cells, 1 / (kinds + 1))
    return both.applyInPandas(_scores(weights, total, kinds), SCORE)
