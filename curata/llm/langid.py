"""Language identification with character language models.

One interpolated Kneser-Ney model per language over code points (letters
lower-cased, every other run of characters one space).  The models are stored
together as sorted arrays of 64-bit n-gram hashes with one log probability per
language, so a position costs one binary search in the common case and backs
off only for n-grams that no language has seen.  A text gets the language of
the lowest cross-entropy per character; how far that may lie above the usual
for its language, and how sure the choice is, are calibrated on labelled texts
that the models have not learned from.

The classifier is fitted on a bounded sample: about ``train_rows`` texts of
each language, and ``calibration_rows`` for the calibration, chosen by a hash
of the id.  Every text is scored whole, in a map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, hash_fold, ident, python_ready

ORDER = 4
PAD = 1                          # stands before a text; never produced by fold()
PIECE = 1 << 20                  # code points scored at a time
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all that is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def fold(text: str) -> np.ndarray:
    """Code points of the folded text, single spaces between letter runs, none at the ends."""
    cps = _fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = cps == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    cps = cps[keep]
    a, b = int(len(cps) > 0 and cps[0] == 32), int(len(cps) > 1 and cps[-1] == 32)
    return cps[a:len(cps) - b]


def _hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points; the last character has the first multiplier."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(grams), np.uint64)
        for k in range(grams.shape[1]):
            h += (grams[:, -1 - k].astype(np.uint64) + np.uint64(1)) * _MULT[k]
    return h


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the sorted hash array, and whether the hash is there."""
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


class Models:
    """Kneser-Ney models of several languages in shared sorted hash arrays."""

    def __init__(self, langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """counts: language -> (distinct n-grams of ORDER code points, their counts)."""
        self.langs = langs
        size = len(langs)
        letters = np.unique(np.concatenate([g[:, -1] for g, _ in counts.values()]))
        self.floor = -np.log(len(letters) + 1.0)                  # uniform, one more for the unseen
        self.keys, self.logp, self.ctx, self.back = {}, {}, {}, {}
        per = {lang: self._types(*counts[lang]) for lang in langs}
        for n in range(1, ORDER + 1):
            grams = np.unique(np.concatenate([per[lang][n][0] for lang in langs]), axis=0)
            h = _hash(grams)
            order = np.argsort(h)
            grams, keys = grams[order], h[order]
            ctx = np.unique(_hash(grams[:, :-1]))
            back = np.zeros((len(ctx), size))
            own = np.zeros((len(keys), size))
            for k, lang in enumerate(langs):
                g, c = per[lang][n]
                ones, twos = np.sum(c == 1), np.sum(c == 2)
                d = ones / (ones + 2.0 * twos) if ones and twos else 0.5
                of, inv = np.unique(_hash(g[:, :-1]), return_inverse=True)
                total, kinds = np.bincount(inv, weights=c), np.bincount(inv)
                at, _ = _find(ctx, of)
                back[at, k] = np.log(d * kinds / total)
                at, _ = _find(keys, _hash(g))
                own[at, k] = np.maximum(c - d, 0) / total[inv]
            at, _ = _find(ctx, _hash(grams[:, :-1]))
            lower = np.full((len(keys), size), self.floor) if n == 1 else self.logp[n - 1][_find(self.keys[n - 1], _hash(grams[:, 1:]))[0]]
            self.keys[n], self.ctx[n], self.back[n] = keys, ctx, back.astype(np.float32)
            self.logp[n] = np.log(own + np.exp(back[at] + lower)).astype(np.float32)

    @staticmethod
    def _types(grams: np.ndarray, counts: np.ndarray) -> dict:
        """For each order the distinct n-grams with their counts: as they occur at
        the highest, and below it the number of distinct continuations."""
        out = {ORDER: (grams, counts.astype(float))}
        for n in range(ORDER - 1, 0, -1):
            low, c = np.unique(out[n + 1][0][:, 1:], axis=0, return_counts=True)
            out[n] = (low, c.astype(float))
        return out

    def positions(self, cps: np.ndarray) -> np.ndarray:
        """Log probability per language of every character; ``cps`` starts with ORDER - 1 characters of context."""
        n = len(cps) - ORDER + 1
        with np.errstate(over="ignore"):
            c = cps.astype(np.uint64) + np.uint64(1)
            h = [c[ORDER - 1:] * _MULT[0]]
            for k in range(1, ORDER):
                h.append(h[-1] + c[ORDER - 1 - k:len(c) - k] * _MULT[k])
            ctx = [np.zeros(n, np.uint64)]
            for k in range(1, ORDER):
                ctx.append(ctx[-1] + c[ORDER - 1 - k:len(c) - k] * _MULT[k - 1])
        at, hit = _find(self.keys[ORDER], h[ORDER - 1])
        out = self.logp[ORDER][at]
        left = np.flatnonzero(~hit)
        out[left] = 0
        for k in range(ORDER, 0, -1):                              # back off where no language has the n-gram
            at, hit = _find(self.ctx[k], ctx[k - 1][left])
            out[left[hit]] += self.back[k][at[hit]]
            if k == 1:
                out[left] += np.float32(self.floor)
                break
            at, hit = _find(self.keys[k - 1], h[k - 2][left])
            out[left[hit]] += self.logp[k - 1][at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def total(self, cps: np.ndarray) -> np.ndarray:
        """Log probability per language of a folded text."""
        padded = np.concatenate([np.full(ORDER - 1, PAD, np.uint32), cps])
        out = np.zeros(len(self.langs))
        for k in range(0, len(cps), PIECE):
            out += self.positions(padded[k:k + PIECE + ORDER - 1]).sum(axis=0, dtype=np.float64)
        return out


class Identifier:
    """Models with their calibration."""

    def __init__(self, models: Models | None):
        self.models = models
        self.langs = models.langs if models else []
        self.usual = np.zeros(len(self.langs))           # cross-entropy usual for the language
        self.limit = np.full(len(self.langs), np.inf)    # most that it may lie above, times the root of the length
        self.sharp = 1.0

    @staticmethod
    def _weight(n: int) -> float:
        return float(np.sqrt(min(n, 200)))

    def entropy(self, text: str | None) -> tuple[int, np.ndarray]:
        cps = fold(text or "")
        n = len(cps)
        return n, (-self.models.total(cps) / n if n and self.models else np.zeros(len(self.langs)))

    def calibrate(self, rows: list[tuple[str, int, list[float]]], slack: float = 2.0, tail: float = 0.999) -> None:
        """rows: (language, length, cross-entropies) of labelled texts not learned from.  A text
        is rejected beyond ``slack`` times what all but 1 - ``tail`` of the calibration texts reach."""
        at = {lang: k for k, lang in enumerate(self.langs)}
        for lang, k in at.items():
            own = [(n, e[k]) for a, n, e in rows if a == lang and n]
            if not own:
                continue
            self.usual[k] = np.median([e for _, e in own])
            over = [(e - self.usual[k]) * self._weight(n) for n, e in own]
            self.limit[k] = slack * max(np.quantile(over, tail), 1.0)
        best = None
        for sharp in 2.0 ** np.arange(-4, 7):
            loss = 0.0
            for lang, n, e in rows:
                if n:
                    z = -np.array(e) * sharp * self._weight(n)
                    z -= z.max()
                    loss -= z[at[lang]] - np.log(np.exp(z).sum())
            if rows and (best is None or loss < best):
                best, self.sharp = loss, float(sharp)

    def judge(self, text: str | None) -> tuple[str, float, bool, float]:
        """(language, score, rejected, cross-entropy); no letter: und, 0, rejected."""
        n, e = self.entropy(text)
        if not n or not self.langs:
            return "und", 0.0, True, 0.0
        k = int(np.argmin(e))
        z = np.exp(-(e - e[k]) * self.sharp * self._weight(n))
        over = (e[k] - self.usual[k]) * self._weight(n)
        return self.langs[k], float(1.0 / z.sum()), bool(over > self.limit[k]), float(e[k])


def _sampled(docs: DataFrame, rows: int, salt: str) -> DataFrame:
    """About ``rows`` of each language, by a hash of id and text (all, if fewer): rows
    that share an id, null or not, are chosen one by one."""
    counts = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}     # one row per language
    if not counts:
        return docs.where(F.lit(False))
    part = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))))
    at = F.pmod(F.xxhash64(F.lit(salt), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return docs.where(at < F.element_at(part, F.col("lang")))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            cps = np.concatenate([np.full(ORDER - 1, PAD, np.uint32), fold(text or "")])
            if len(cps) >= ORDER:
                by.setdefault(lang, []).append(np.lib.stride_tricks.sliding_window_view(cps, ORDER))
        for lang, parts in by.items():
            g = np.concatenate(parts)
            _, first, n = np.unique(_hash(g), return_index=True, return_counts=True)
            g = g[first].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), *(pa.array(g[:, k]) for k in range(ORDER)), pa.array(n.astype(np.int64))],
                names=["lang", *(f"c{k}" for k in range(ORDER)), "n"])


def _entropies(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = model.value
        for batch in batches:
            got = [who.entropy(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([e.tolist() for _, e in got], pa.list_(pa.float64()))], names=["lang", "n", "e"])
    return run


def train(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          train_rows: int = 3000, calibration_rows: int = 300) -> Identifier:
    """Fit the models on labelled rows for which ``learn`` holds.

    Three quarters of them (by another hash of id and text) may teach, the rest
    calibrates; a language with rows in only one part uses it for both.  Rows
    with a null label or text teach nothing.  Without any row the result
    predicts ``und`` for everything.
    """
    spark = docs.sparkSession
    python_ready(spark)
    d = docs.where(learn).select(ident(doc_id).alias("doc_id"), ident(text).alias("text"), ident(lang).alias("lang"))
    d = d.where("lang IS NOT NULL AND text IS NOT NULL")
    teach = F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(4)) != 0
    made = "lang string, " + ", ".join(f"c{k} int" for k in range(ORDER)) + ", n long"

    def grams(rows: DataFrame) -> pd.DataFrame:
        cols = ["lang", *(f"c{k}" for k in range(ORDER))]
        return (_sampled(rows, train_rows, "teach").select("lang", "text").mapInArrow(_gram_counts, made)
                .groupBy(*cols).agg(F.sum("n").alias("n")).toPandas())       # bounded by the sample
    got = grams(d.where(teach))
    missing = sorted({r[0] for r in d.select("lang").distinct().collect()} - set(got["lang"]))
    if missing:
        got = pd.concat([got, grams(d.where(F.col("lang").isin(missing)))])
    counts = {k: (g[[f"c{j}" for j in range(ORDER)]].to_numpy(np.uint32), g["n"].to_numpy()) for k, g in got.groupby("lang")}
    langs = sorted(counts)
    who = Identifier(Models(langs, counts) if langs else None)
    if langs:
        shared = spark.sparkContext.broadcast(who)

        def measured(rows: DataFrame):
            got = _sampled(rows.where(F.col("lang").isin(langs)), calibration_rows, "calibrate").select("lang", "text")
            return [(r["lang"], r["n"], r["e"]) for r in got.mapInArrow(_entropies(shared), "lang string, n long, e array<double>").collect()]
        rows = measured(d.where(~teach))
        none = sorted(set(langs) - {r[0] for r in rows})
        if none:
            rows += measured(d.where(F.col("lang").isin(none)))
        who.calibrate(sorted(rows, key=lambda r: (r[0], r[1], r[2])))
    return who


def predict(docs: DataFrame, who: Identifier, text: str = "text", names=("lang_pred", "score", "rejected", "entropy")) -> DataFrame:
    """All columns of ``docs`` plus the four of ``names`` (a column of that name is replaced).

    A text that is null or has no letter is ``und`` with score 0 and rejected.
    Equal entropies go to the language first in code point order.
    """
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(who)
    low = [n.lower() for n in names]
    kept = [c for c in docs.columns if c.lower() not in low]
    (tmp,) = fresh([*docs.columns, *names], "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = shared.value
        for batch in batches:
            got = [who.judge(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*batch.schema.names[:-1], *names])

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType(), T.DoubleType())
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), *(T.StructField(n, t) for n, t in zip(names, kinds))])
    return docs.select(*(ident(c) for c in kept), ident(text).alias(tmp)).mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return hash_fold(doc_id, folds) == fold


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, entropy of every row; learned from the rows not held out."""
    who = train(docs, ~held_out(ident(doc_id)), doc_id, text, lang)
    d = docs.select(ident(doc_id).alias("doc_id"), held_out(ident(doc_id)).alias("held_out"), ident(text).alias("text"))
    return predict(d, who).drop("text")


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is identified, in its columns: texts
    without a letter and texts unlike every learned language go."""
    names = fresh(docs.columns, "lang_pred", "score", "rejected", "entropy")
    who = train(docs, ~held_out(ident(doc_id)), doc_id, text, lang)
    return predict(docs, who, text, tuple(names)).where(~F.col(names[2])).select(*(ident(c) for c in docs.columns))
