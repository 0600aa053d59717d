"""Embedding whitening through an exact characteristic polynomial.

Entries become integers x = floor(scale * c), so with n different vectors x and their
sums S the matrix M = n * sum(x x') - S S' is exact and the covariance is M / n^2.

1. Spark sums x x' and S over the different vectors exactly: every task adds up its
   rows as integers and hands over one row per matrix entry and limb.
2. The characteristic polynomial of M modulo many 31-bit primes, each by reduction
   to Hessenberg form: the primes are rows of a Spark job.  As many primes are
   taken as bound every coefficient (M has no negative eigenvalue, so coefficient k is at
   most C(d, k) (trace/d)^k); Chinese remaindering gives the polynomial itself.
3. All its roots are real, so the sign changes of the coefficients of p(x + a) count
   the roots above a exactly, multiples included.  Bisection with these counts
   isolates the largest roots, then signs refine each far beyond double
   precision.
4. Components span the null space of M - root * I: inverse iteration in fixed-point
   integers of several hundred bits, one Spark row per root; a multiple root takes as
   many start vectors as its multiplicity.

What reaches the driver is bounded by the dimension, never by the number of rows.
Step 2 costs d^3 a prime and about d * log2(trace) / 31 primes, so the method is meant
for up to some hundred dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ident, python_ready, written

LIMB = 21                    # bits of the pieces that are multiplied as doubles, exactly
SUM_LIMB = 40                # bits of the pieces that Spark adds up
ROWS = 512                   # rows per exact product: 2 * 21 + 9 bits fit a double
ROOT_BITS = 110              # relative precision of the roots


# ------------------------------------------------------------------ exact sums
def exact_scatter(x: np.ndarray) -> np.ndarray:
    """x' x of a long matrix of up to ROWS rows, as Python integers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    pieces, rest = [], x
    while top >= 1 << LIMB:
        pieces.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB
        top = (top >> LIMB) + 1
    pieces.append(rest.astype(np.float64))
    out = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(pieces):
        for j, b in enumerate(pieces):
            out = out + ((a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j)))
    return out


def _limbs(v: int) -> list[int]:
    """Pieces of SUM_LIMB bits, lowest first, the sign in the last; zero has none."""
    out = []
    while v not in (0, -1):
        out.append(v & ((1 << SUM_LIMB) - 1))
        v >>= SUM_LIMB
    if v:
        out.append(-1)
    return out


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (dim, i, j, limb, v): sums of x_i x_j (j >= i), of x_i (j = -1) and of rows (i = j = -1)."""
    pairs: dict[int, np.ndarray] = {}
    sums: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for batch in batches:
        col = batch.column(0)
        lengths = np.diff(col.offsets.to_numpy())
        flat = col.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        for d in np.unique(lengths).tolist():
            if not d:
                continue
            at = (ends[lengths == d] - d)[:, None] + np.arange(d)
            x = flat[at]
            for a in range(0, len(x), ROWS):
                part = x[a:a + ROWS]
                pairs[d] = pairs.get(d, 0) + exact_scatter(part)
                sums[d] = sums.get(d, 0) + part.astype(object).sum(axis=0)
            count[d] = count.get(d, 0) + len(x)
    rows = []
    for d in pairs:
        rows += [(d, -1, -1, k, v) for k, v in enumerate(_limbs(count[d]))]
        for i in range(d):
            rows += [(d, i, -1, k, v) for k, v in enumerate(_limbs(int(sums[d][i])))]
            for j in range(i, d):
                rows += [(d, i, j, k, v) for k, v in enumerate(_limbs(int(pairs[d][i, j])))]
    cols = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["dim", "i", "j", "limb", "v"])


def moments(different: DataFrame, vec: str = "x") -> dict[int, tuple[int, list[int], np.ndarray]]:
    """{dimension: (n, S, sum of x x')} of the rows of ``vec`` (array<long>), exact."""
    got = (different.select(vec).mapInArrow(_partial_sums, "dim int, i int, j int, limb int, v long")
           .groupBy("dim", "i", "j", "limb").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())    # d^2 limbs a dimension
    out = {}
    for d in sorted({r["dim"] for r in got}):
        n, s, xx = 0, [0] * d, np.zeros((d, d), object)
        for r in got:
            if r["dim"] != d:
                continue
            v = int(r["v"]) << (SUM_LIMB * r["limb"])
            if r["i"] < 0:
                n += v
            elif r["j"] < 0:
                s[r["i"]] += v
            else:
                xx[r["i"], r["j"]] += v
                if r["i"] != r["j"]:
                    xx[r["j"], r["i"]] += v
        out[d] = (n, s, xx)
    return out


# ------------------------------------------------------------------ characteristic polynomial
def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    small = [p for p in range(2, 1 << 8) if all(p % q for q in range(2, int(p ** 0.5) + 1))]

    def prime(n: int) -> bool:
        if any(n % p == 0 for p in small):
            return n in small
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for a in (2, 3, 5, 7):                                  # decides below 3.2e9
            x = pow(a, odd, n)
            if x in (1, n - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
        return True
    out, n = [], top
    while len(out) < count:
        n -= 1
        if prime(n):
            out.append(n)
    return out


def charpoly_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first, leading 1 last) of det(xI - m) modulo a prime below 2^31."""
    h = np.array(m % p, np.int64)
    d = len(h)
    for k in range(d - 2):                                      # similarity steps: zeros below the subdiagonal
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        f = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - f[:, None] * h[k + 1] % p) % p
        for a in range(0, d, 256):                              # h[:, k+2:] @ f without overflow
            h[a:a + 256, k + 1] = (h[a:a + 256, k + 1] + (h[a:a + 256, k + 2:] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)                  # row k: the leading k x k minor's polynomial
    polys[0, 0] = 1
    for k in range(d):
        row = np.roll(polys[k], 1)
        row[0] = 0
        row = (row - h[k, k] * polys[k]) % p
        down = 1
        for i in range(k - 1, -1, -1):
            down = down * int(h[i + 1, i]) % p
            if not down:
                break
            row = (row - (int(h[i, k]) * down % p) * polys[i] % p) % p
        polys[k + 1] = row
    return polys[d].tolist()


def charpoly(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients of det(xI - m), constant first, of a symmetric integer matrix without negative eigenvalues."""
    d, trace = len(m), int(np.trace(m))
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound + 1).bit_length() // 30 + 1)
    shared = spark.sparkContext.broadcast(m)                    # d^2 integers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"p": pdf["p"], "c": [charpoly_mod(shared.value, int(p)) for p in pdf["p"]]})
    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInPandas(run, "p long, c array<long>").collect()
    total, out = 1, [0] * (d + 1)
    for p, c in rows:
        inverse = pow(total, -1, p)
        out = [a + total * ((b - a) * inverse % p) for a, b in zip(out, c)]
        total *= p
    return [a - total if 2 * a > total else a for a in out]


# ------------------------------------------------------------------ roots
def _changes(c: list[int], at: int, bits: int) -> int:
    """Roots above at / 2^bits of a polynomial whose roots are all real (with multiplicity)."""
    d = len(c) - 1
    c = [a << (bits * (d - k)) for k, a in enumerate(c)]        # roots times 2^bits
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(c: list[int], at: int, bits: int) -> int:
    v, d = 0, len(c) - 1
    for k in range(d, -1, -1):
        v = v * at + (c[k] << (bits * (d - k)))
    return (v > 0) - (v < 0)


def largest_roots(c: list[int], count: int) -> list[tuple[int, int, int]]:
    """(numerator, bits, multiplicity) of the largest positive roots, falling, until
    ``count`` roots are counted; each root is numerator / 2^bits to ROOT_BITS bits.
    Roots that do not part at that precision count as one of their common multiplicity."""
    while c and c[0] == 0:
        c = c[1:]                                               # zero roots
    d = len(c) - 1
    found, have = [], 0
    while have < min(count, d):
        lo, hi, bits = 0, max(1, -c[-2]), 0                     # the trace bounds every root
        n_lo, n_hi, side = d, 0, 0                              # roots above lo and above hi; the root sought is between
        while hi - lo > 1 or lo >> ROOT_BITS == 0:
            if hi - lo == 1:
                lo, hi, bits = lo << 16, hi << 16, bits + 16
            mid = (lo + hi) // 2
            if side:                                            # one root in (lo, hi]: its half by sign
                s = _sign(c, mid, bits)
                if s == 0:
                    hi = mid
                    break
                above = s == side
            else:
                n = _changes(c, mid, bits)
                above = n > have
                n_lo, n_hi = (n, n_hi) if above else (n_lo, n)
            lo, hi = (mid, hi) if above else (lo, mid)
            if not side and n_lo - n_hi == 1:
                side = _sign(c, lo, bits)                       # 0: lo is the next root, so counting goes on
        found.append((hi, bits, n_lo - have))
        have = n_lo
    return found


# ------------------------------------------------------------------ null spaces
def null_space(m: np.ndarray, root: int, bits: int, multiplicity: int) -> np.ndarray:
    """Orthonormal columns spanning the eigenspace of ``root`` / 2^bits, by inverse iteration in integers."""
    d = len(m)
    scale = max(bits, 0) + 200 + int(root).bit_length()         # fixed point: value * 2^scale
    a = np.array(m, object) << scale
    for i in range(d):
        a[i, i] -= root << (scale - bits)
    order = list(range(d))
    for k in range(d):                                          # LU with row pivots, in place
        r = max(range(k, d), key=lambda i: abs(a[i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
            order[k], order[r] = order[r], order[k]
        if a[k, k] == 0:
            a[k, k] = 1                                         # a null direction
        if k + 1 < d:
            f = (a[k + 1:, k] << scale) // a[k, k]
            a[k + 1:, k] = f
            a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - ((f[:, None] * a[k, k + 1:][None]) >> scale)
    start = np.random.default_rng(5).integers(-(1 << 30), 1 << 30, (d, multiplicity))
    w = np.array(start.tolist(), object) << (scale - 31)
    for _ in range(6):
        w = w[order]
        for k in range(d):                                      # forward, backward
            w[k + 1:] = w[k + 1:] - ((a[k + 1:, k][:, None] * w[k][None]) >> scale)
        for k in range(d - 1, -1, -1):
            w[k] = (w[k] << scale) // a[k, k]
            w[:k] = w[:k] - ((a[:k, k][:, None] * w[k][None]) >> scale)
        for j in range(multiplicity):                           # Gram-Schmidt in fixed point, each column near length one
            for i in range(j):
                dot = sum(x * y for x, y in zip(w[:, i], w[:, j])) >> scale
                w[:, j] = w[:, j] - ((dot * w[:, i]) >> scale)
            size = math.isqrt(sum(x * x for x in w[:, j]))
            w[:, j] = np.array([(x << scale) // max(size, 1) for x in w[:, j]], object)
    out = np.array([[_ratio(x, scale) for x in row] for row in w], float)
    return out / np.sqrt((out * out).sum(axis=0))


def _ratio(x: int, bits: int) -> float:
    drop = max(0, abs(x).bit_length() - 64)
    return math.ldexp(float(x >> drop), drop - bits)


class Whitening:
    """Fitted components of one dimension: unit vectors as rows, falling eigenvalues of M."""

    def __init__(self, n: int, s: list[int], vectors: np.ndarray, roots: list[float], explained: list[float]):
        self.n, self.s, self.vectors, self.roots, self.explained = n, s, vectors, roots, explained

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(whitened, one column per component; deviation of every row)."""
        top = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
        reach = self.n * top + max(map(abs, self.s))
        if reach * reach * x.shape[1] < 1 << 63:
            y = x * np.int64(self.n) - np.array(self.s, np.int64)
            deviation = (y * y).sum(axis=1).tolist()
        else:
            y = x.astype(object) * self.n - np.array(self.s, object)
            deviation = (y * y).sum(axis=1).tolist()
        y = y.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return (y @ self.vectors.T) / np.sqrt(np.array(self.roots)), deviation


def fit(spark: SparkSession, n: int, s: list[int], xx: np.ndarray, components: int) -> Whitening:
    """The first ``components`` components (fewer, if the dimension is smaller).  A component
    of no variance has eigenvalue 0 and a zero vector."""
    d = len(s)
    s_ = np.array(s, object)
    m = xx * n - s_[:, None] * s_[None]
    trace = int(np.trace(m))
    wanted = min(components, d)
    found = largest_roots(charpoly(spark, m), wanted) if trace else []
    shared = spark.sparkContext.broadcast(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [null_space(shared.value, int(r), int(b), int(k)).T.reshape(-1).tolist()
                   for r, b, k in zip(pdf["root"], pdf["bits"], pdf["m"])]
            yield pd.DataFrame({"at": pdf["at"], "v": got})
    vectors, roots = np.zeros((wanted, d)), [0.0] * wanted
    if found:
        before = [sum(k for _, _, k in found[:i]) for i in range(len(found))]
        rows = [(i, str(r), b, min(k, wanted - before[i])) for i, (r, b, k) in enumerate(found)]
        got = (spark.createDataFrame(rows, "at int, root string, bits long, m long").repartition(len(rows))
               .mapInPandas(run, "at int, v array<double>").collect())                 # a few vectors
        spaces = {r["at"]: np.array(r["v"]).reshape(-1, d) for r in got}
        every = [(v, _ratio(r, b)) for k, (r, b, _) in enumerate(found) for v in spaces[k]]
        for k, (v, e) in enumerate(every[:wanted]):
            vectors[k], roots[k] = v, e
    return Whitening(n, s, vectors, roots, [r / trace if trace else 0.0 for r in roots])


def integers(vectors: DataFrame, vec_id: str, vec: str, scale: int) -> DataFrame:
    """(vec_id, x) of the rows whose vector is not null and holds finite entries only; x = floor(scale * c), within the long range."""
    c = ident(vec).cast("array<double>")
    d = vectors.select(ident(vec_id).alias("vec_id"), c.alias("c")).where("c IS NOT NULL")
    bad = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    top = float(1 << 62)
    x = F.transform("c", lambda v: F.floor(F.greatest(F.least(v * F.lit(float(scale)), F.lit(top)), F.lit(-top))))
    return d.where(~bad).select("vec_id", x.alias("x"))


SCHEMA = ("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", components: int = 4,
           scale: int = 256) -> DataFrame:
    """Every remaining row projected on the first principal components, with unit variances.

    Rows whose vector is null or holds null or non-finite entries are dropped; every
    other row (null and repeated ids included) gives one row per component, up to the
    dimension: vec_id, component, n (different vectors of that length), deviation (sum
    over dimensions of (n x - S)^2, exact; null beyond 38 digits), whitened (null if
    the component has no variance), explained (its share of the trace), identity_error
    (largest entry by which the covariance of whitened over the different vectors differs from the
    identity; components without variance do not count; null if there is none).
    Vectors of every length have a fit of their own; empty vectors and an empty table give no row.
    Entries beyond 2^62 / scale count as that bound.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    rows = integers(vectors, vec_id, vec, scale)
    different = written(rows.select("x").distinct(), "whiten")
    fits = {d: fit(spark, *m, components) for d, m in moments(different).items()}
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not fits:
        return spark.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    shared = spark.sparkContext.broadcast(fits)                        # components x dimension numbers

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, w, _, _ in _projected(batch.column(0), shared.value):
                cols = [pa.array(w[:, k] if k < w.shape[1] else np.full(len(w), np.nan), pa.float64()) for k in range(components)]
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(w), pa.int32()), *cols],
                                                 names=["dim", *(f"w{k}" for k in range(components))])
    names = [f"w{k}" for k in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    cov = (different.mapInArrow(wide, "dim int, " + ", ".join(f"{k} double" for k in names)).groupBy("dim")
           .agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect())        # one row a dimension
    error = {}
    for r in cov:
        alive = [k for k, e in enumerate(fits[r["dim"]].roots) if e > 0]
        error[r["dim"]] = max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if i in alive and j in alive), default=None)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, w, deviation, at in _projected(batch.column(1), shared.value):
                own, k = shared.value[d], w.shape[1]
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                flat = w.reshape(-1)
                each = pa.array(np.repeat(np.arange(len(w)), k))
                exact = pa.array([Decimal(v) if v < 10 ** 38 else None for v in deviation], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1), len(w)), pa.int32()), pa.array([own.n] * len(flat), pa.int64()),
                    exact.take(each), pa.array(flat, pa.float64(), mask=~np.isfinite(flat)), pa.array(np.tile(own.explained, len(w)), pa.float64()),
                    pa.array([error.get(d)] * len(flat), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.select("vec_id", "x").mapInArrow(out, f"vec_id {kind}, {SCHEMA}")


def _projected(col, fits: dict[int, Whitening]):
    """(dimension, whitened, deviations, row numbers) of the vectors of each length in an Arrow list column."""
    lengths = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        if d in fits:
            at = np.flatnonzero(lengths == d)
            w, deviation = fits[d].apply(flat[starts[at][:, None] + np.arange(d)])
            yield d, w, deviation, at
