"""Periodic runs of words: stretches that repeat a passage at least four times.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that holds at least ``min_words`` words and ``repeats`` periods
and that no neighbouring word extends.  Runs are sought per document, at one
scale per power of two:

* periods up to ``SHORT`` by direct lag scans: every word against the word q
  places on;
* periods in (k/2, k] by minimizers of scale k: k-word passages get exact names
  (by doubling: a passage's name is that of the pair of its halves), and of every
  k/2 consecutive passages the one whose scrambled name is least (leftmost, on
  ties) is kept.  Inside a run of period q the passages of a window reappear q
  words later, so their minima do too, and no equal passage lies between, because
  a passage at least as long as the period fixes the place in the period.  So
  two neighbours among the kept passages of one name are q apart; every such
  pair with a distance in (k/2, k] is extended word by word to the whole
  stretch.  A run of four periods holds enough windows for this at its scale.

A scale at which no passage occurs twice ends the search.  The pairs of one scale
number about 4n/k and an extension that leads to no run takes less than 4k steps,
so a text of n words costs about n log n, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ident, python_ready

MIN_WORDS = 6
REPEATS = 4
SHORT = 8                                           # periods up to here are scanned directly
SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)            # odd: distinct names stay distinct


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _prime_divisors(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return out + [q] if q > 1 else out


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch from ``start`` with period q (of 2q words or more) has no smaller one."""
    head = ids[start:start + q]
    return not any(np.array_equal(head, ids[start + q // r:start + q // r + q]) for r in _prime_divisors(q))


def _lag_scan(ids: np.ndarray, q: int, least: int) -> list[tuple[int, int]]:
    """(start, length) of every stretch of period q with at least ``least`` words."""
    same = ids[q:] == ids[:-q]
    if np.count_nonzero(same) < least - q:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    start, length = edges[::2], edges[1::2] - edges[::2] + q
    return [(int(s), int(n)) for s, n in zip(start, length) if n >= least]


def _extended(ids: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """(start, stop) of the longest stretch of period q around the equal words at ``at`` and ``at + q``."""
    step, stop = 64, at
    while stop + q < len(ids):
        a, b = ids[stop:stop + step], ids[stop + q:stop + q + step]
        bad = np.flatnonzero(a[:len(b)] != b)
        if len(bad):
            stop += int(bad[0])
            break
        stop += len(b)
        step *= 2
    step, start = 64, at
    while start > 0:
        low = max(0, start - step)
        bad = np.flatnonzero(ids[low:start] != ids[low + q:start + q])
        if len(bad):
            start = low + int(bad[-1]) + 1
            break
        start = low
        step *= 2
    return start, stop + q


def _doubled(name: np.ndarray, k: int) -> np.ndarray:
    """Names of the 2k-word passages from those of the k-word passages."""
    pair = name[:-k] * (int(name.max()) + 1) + name[k:]
    return np.unique(pair, return_inverse=True)[1].reshape(-1)


def _window_minima(name: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost least scrambled name of every ``width`` (a power of two) neighbours."""
    key = name.astype(np.uint64) * SCRAMBLE
    at, half = np.arange(len(key)), 1
    while half < width:
        a, b = at[:-half], at[half:]
        at = np.where(key[a] <= key[b], a, b)
        half *= 2
    kept = np.zeros(len(key), bool)
    kept[at] = True
    return np.flatnonzero(kept)


def find_runs(words: list[bytes], min_words: int = MIN_WORDS, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if repeats < 4:
        raise ValueError("the minimizers of a scale need at least four periods")
    n, found = len(words), set()
    if n < min_words:
        return []
    ids = _numbered(words)
    for q in range(1, min(SHORT, n // repeats) + 1):
        for start, length in _lag_scan(ids, q, max(min_words, repeats * q)):
            if _smallest(ids, start, q):
                found.add((start, length, q))
    name, k = ids, 1
    while k < 2 * (n // repeats):
        if k > SHORT:
            at = _window_minima(name, k // 2)
            at = at[np.argsort(name[at], kind="stable")]
            apart = np.diff(at)
            near = (name[at[1:]] == name[at[:-1]]) & (apart > k // 2) & (apart <= k)
            seen: dict[int, int] = {}                                     # period: end of its last stretch
            for at_, q in sorted(zip(at[:-1][near].tolist(), apart[near].tolist())):
                if at_ + q < seen.get(q, 0):
                    continue                                              # within a stretch already extended
                start, stop = _extended(ids, at_, q)
                seen[q] = stop
                if stop - start >= max(min_words, repeats * q) and _smallest(ids, start, q):
                    found.add((start, stop - start, q))
        if len(name) <= k or int(name.max()) + 1 == len(name):
            break                                                         # no passage of this length occurs twice
        name, k = _doubled(name, k), 2 * k
    return sorted((s, n_, q) for s, n_, q in found)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, q in runs:
        gone[start + q:start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


RUNS = "array<struct<start:long,length:long,period:long>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
           repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length,
    period by start, then period; words count from 0), collapsed (the kept words
    joined by one space).

    A null or blank text has no words: no run, an empty ``collapsed``.  Rows with
    a null or repeated id each keep their row.  Other columns do not take part.
    Documents are independent: one map over the rows, no shuffle.
    """
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, kept = [], [], []
            for raw in batch.column(1).to_pylist():
                words = (raw or b"").split()              # bytes: splits at space and \x09-\x0D, nothing else
                got = find_runs(words, min_words, repeats)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in got])
                kept.append(b" ".join(collapse(words, got)).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, _ARROW_RUNS), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.select(ident(doc_id)).schema[0].dataType.simpleString()
    return (docs.select(ident(doc_id).alias("doc_id"), ident(text).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string"))
