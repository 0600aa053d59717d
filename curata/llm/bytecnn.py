"""Document quality by a small convolutional network over bytes, in numpy.

The network reads the UTF-8 bytes of a whole text:

* every byte has a learned vector; ``FILTERS`` learned filters look at each
  window of ``WIDTH`` bytes (windows start at every byte);
* the text is cut into blocks of ``HOP`` bytes (the last one ends with the text)
  and a chunk is two neighbouring blocks, so chunks overlap by half and cover the
  whole text.  A filter's value for a chunk is its maximum over the chunk;
* a dense layer turns the filter values of a chunk into ``HIDDEN`` features, their
  maxima over all chunks are the text's features, and a logistic unit
  combines those into one probability.

The network is trained on the driver by Adam on a sample of labelled texts whose
size is bounded by parameters (``train_rows`` a class, ``train_bytes`` a text), and
a part of the sample that teaches nothing chooses the epoch and fits the scale and
offset of the probability to the classes' true shares.  Scoring is one map over the
texts.  The same rows give the same network at every size and partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_fold, ident, python_ready

DIM, WIDTH, FILTERS, HIDDEN = 8, 8, 32, 16
HOP = 128
PAD = 256                            # stands after the last byte of a text
GROUP = 256                          # blocks per matrix product


def _block_starts(n: int) -> np.ndarray:
    if n <= HOP:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - HOP, HOP), n - HOP)


class Net:
    """Parameters and passes of the network.  ``seed`` fixes the start."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)

        def init(*shape, fan):
            return (r.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)
        self.p = {
            "embed": init(PAD + 1, DIM, fan=1), "conv": init(WIDTH * DIM, FILTERS, fan=WIDTH * DIM),
            "conv_b": np.zeros(FILTERS, np.float32), "dense": init(FILTERS, HIDDEN, fan=FILTERS),
            "dense_b": np.zeros(HIDDEN, np.float32), "out": init(HIDDEN, fan=HIDDEN), "out_b": np.zeros(1, np.float32),
        }
        self.scale, self.offset = 1.0, 0.0

    def _blocks(self, data: np.ndarray, starts: np.ndarray, places: bool = False):
        """Filter maxima of the blocks of one text from ``starts`` on, and the windows they stand at if ``places``."""
        n, low, high = len(data), int(starts[0]), int(starts[-1]) + HOP + WIDTH - 1
        codes = np.full(high - low, PAD, np.int16)
        codes[:max(0, min(n, high) - low)] = data[low:high]
        x = self.p["embed"][codes[(starts - low)[:, None] + np.arange(HOP + WIDTH - 1)]]
        x = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2)
        y = (x.reshape(len(starts) * HOP, WIDTH * DIM) @ self.p["conv"]).reshape(len(starts), HOP, FILTERS)
        if n < HOP:
            y = y[:, :max(n, 1)]                              # windows start at bytes of the text only
        if not places:
            return y.max(axis=1), None
        at = y.argmax(axis=1)
        return np.take_along_axis(y, at[:, None], 1)[:, 0], at + starts[:, None]

    def _chunks(self, top: np.ndarray) -> np.ndarray:
        pooled = np.maximum(top[:-1], top[1:]) if len(top) > 1 else top
        return np.maximum(pooled + self.p["conv_b"], 0)

    def features(self, raw: bytes) -> np.ndarray:
        """Chunk maxima of the hidden features, a group of blocks at a time: memory does not grow with the text."""
        data = np.frombuffer(raw, np.uint8)
        starts = _block_starts(len(data))
        best, last = None, None
        for a in range(0, len(starts), GROUP):
            top, _ = self._blocks(data, starts[a:a + GROUP])
            if last is not None:
                top = np.concatenate([last, top])
            h = np.maximum(self._chunks(top) @ self.p["dense"] + self.p["dense_b"], 0).max(axis=0)
            best, last = h if best is None else np.maximum(best, h), top[-1:]
        return best

    def logit(self, raw: bytes) -> float:
        return float(self.features(raw) @ self.p["out"] + self.p["out_b"][0])

    def probability(self, raw: bytes) -> float:
        z = self.scale * self.logit(raw) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray):
        """Weighted logistic loss of a batch and its gradients; a maximum hands its
        gradient to the one place it stands at."""
        p = self.p
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        loss = 0.0
        for raw, y, w in zip(texts, labels, weights):
            data = np.frombuffer(raw, np.uint8)
            top, where = self._blocks(data, _block_starts(len(data)), True)       # a training text is of bounded length
            padded = np.append(data.astype(np.int16), np.full(WIDTH, PAD, np.int16))
            if len(top) > 1:
                right = top[1:] > top[:-1]
                where = np.where(right, where[1:], where[:-1])
            c = self._chunks(top)
            h = np.maximum(c @ p["dense"] + p["dense_b"], 0)
            at = h.argmax(axis=0)
            f = h[at, np.arange(HIDDEN)]
            z = float(f @ p["out"] + p["out_b"][0])
            loss += w * float(np.logaddexp(0, -z) if y else np.logaddexp(0, z))
            dz = np.float32(w * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y))
            grad["out"] += dz * f
            grad["out_b"] += dz
            df = dz * p["out"] * (f > 0)                   # one per hidden feature, at chunk at[j]
            grad["dense"] += c[at].T * df
            grad["dense_b"] += df
            dc = (df[:, None] * p["dense"].T) * (c[at] > 0)            # hidden feature x filter
            grad["conv_b"] += dc.sum(axis=0)
            codes = padded[where[at][:, :, None] + np.arange(WIDTH)]   # hidden feature x filter x window
            x = p["embed"][codes].reshape(HIDDEN, FILTERS, WIDTH * DIM)
            grad["conv"] += np.einsum("jf,jfk->kf", dc, x)
            dx = dc[:, :, None] * p["conv"].T[None]
            np.add.at(grad["embed"], codes.reshape(-1), dx.reshape(-1, DIM))
        return loss / len(texts), {k: g / len(texts) for k, g in grad.items()}

    def fit(self, rows: list[tuple[bytes, int]], check: list[tuple[bytes, int]], shares: dict[int, float],
            epochs: int = 8, batch: int = 16, rate: float = 4e-3, seed: int = 11) -> Net:
        """Learn ``rows``; ``check`` chooses the epoch and calibrates.  ``shares`` are the classes' shares of all labelled rows."""
        labels = np.array([y for _, y in rows], np.float32)
        per = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
        weight = np.array([0.5 * len(rows) / per[int(y)] for y in labels], np.float32)     # both classes weigh alike
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        best, kept, step = None, self.p, 0
        total = epochs * max(1, -(-len(rows) // batch))
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for a in range(0, len(rows), batch):
                own = order[a:a + batch]
                _, grad = self.gradients([rows[i][0] for i in own], labels[own], weight[own])
                step += 1
                now = rate * (1 - step / (total + 1))
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
            z = np.array([self.logit(raw) for raw, _ in check])
            y = np.array([k for _, k in check])
            w = self._weights(y, shares)
            loss = float((w * np.logaddexp(0, np.where(y == 1, -z, z))).sum())
            if best is None or loss < best:
                best, kept = loss, {k: x.copy() for k, x in self.p.items()}
        self.p = kept
        if check:
            self.calibrate(np.array([self.logit(raw) for raw, _ in check]), np.array([k for _, k in check]), shares)
        return self

    @staticmethod
    def _weights(y: np.ndarray, shares: dict[int, float]) -> np.ndarray:
        n = {k: max(1, int((y == k).sum())) for k in (0, 1)}
        return np.array([shares.get(int(k), 0.0) / n[int(k)] for k in y])

    def calibrate(self, z: np.ndarray, y: np.ndarray, shares: dict[int, float]) -> None:
        """Scale and offset of the logit by weighted logistic regression (Newton steps, slightly ridged)."""
        w = self._weights(y, shares) * len(y)
        x = np.stack([z, np.ones_like(z)], axis=1)
        b, target = np.array([1.0, 0.0]), y.astype(float)
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
            g = x.T @ (w * (q - target)) + 0.01 * (b - [1.0, 0.0])
            h = (x * (w * q * (1 - q))[:, None]).T @ x + 0.01 * np.eye(2)
            b = b - np.clip(np.linalg.solve(h, g), -1, 1)
        self.scale, self.offset = float(max(b[0], 1e-3)), float(b[1])


def sample(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str, text: str, label: str,
           train_rows: int, train_bytes: int) -> tuple[list[tuple[int, str, int, bytes]], dict[int, float]]:
    """About ``train_rows`` labelled texts of each class, by a hash of the id, and the classes' shares.

    An id's label is the larger of its labels and its text the least of its
    texts; null ids, labels and texts and texts over ``train_bytes`` teach nothing.
    """
    lab = labels.where(learn).groupBy(ident(doc_id).alias("id")).agg(F.max(ident(label)).alias("y"))
    lab = lab.where("id IS NOT NULL AND y IN (0, 1)").select("id", F.col("y").cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in lab.groupBy("y").count().collect()}              # two rows at most
    if not counts:
        return [], {}
    part = F.create_map(*(F.lit(x) for y, n in counts.items() for x in (y, min(1.0, train_rows / n))))
    at = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30))
    few = lab.withColumn("at", at).where(F.col("at") / float(1 << 30) < F.element_at(part, F.col("y")))
    texts = docs.select(ident(doc_id).alias("id"), ident(text).alias("text"))
    found = (texts.where("text IS NOT NULL").where(F.octet_length("text") <= train_bytes)
             .join(F.broadcast(few), "id")                                                # 2 * train_rows rows
             .groupBy("id", "y", "at").agg(F.min("text").alias("text")))
    rows = sorted((r["at"], str(r["id"]), r["y"], r["text"].encode("utf-8")) for r in found.collect())
    total = sum(counts.values())
    return rows, {y: n / total for y, n in counts.items()}


def train(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", train_rows: int = 2000, train_bytes: int = 1 << 16, epochs: int = 6) -> Net:
    """The network fitted on labelled rows for which ``learn`` (a condition on ``labels``) holds.

    One sampled row of four checks and calibrates.  Without labels of both classes
    the result gives every text the share of class 1 (0.5 without any label).
    """
    rows, shares = sample(docs, labels, learn, doc_id, text, label, train_rows, train_bytes)
    net = Net()
    if {y for _, _, y, _ in rows} != {0, 1}:
        share = shares.get(1, 0.0 if shares else 0.5)
        net.scale, net.offset = 0.0, float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -14, 14))
        return net
    by = {y: [(raw, k) for _, _, k, raw in rows if k == y] for y in (0, 1)}
    check = [r for own in by.values() for r in own[::4]] if min(map(len, by.values())) > 4 else [r for own in by.values() for r in own]
    teach = [r for own in by.values() for i, r in enumerate(own) if i % 4] if min(map(len, by.values())) > 4 else check
    return net.fit(teach, check, shares, epochs)


def predict(docs: DataFrame, net: Net, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (probability of class 1) of every row; a null text is the empty text, which has a score too."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(net)             # some 10,000 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = shared.value
        for batch in batches:
            got = [who.probability(raw or b"") for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    kind = docs.select(ident(doc_id)).schema[0].dataType.simpleString()
    return (docs.select(ident(doc_id).alias("doc_id"), ident(text).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double"))


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return hash_fold(doc_id, folds) == fold


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          threshold: float = 0.3, **training) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; learned from
    the labels of ids not held out.  Repeated rows and null ids each keep their row."""
    net = train(docs, labels, ~held_out(ident(doc_id)), doc_id, text, label, **training)
    d = predict(docs, net, doc_id, text)
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
