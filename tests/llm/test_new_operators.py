"""Embedding whitening, periodic runs and the quality network against brute-force versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from curata.llm import bytecnn, periodic, queries, whitening
from curata.llm.common import table
from helpers import docs_frame, fold


# ------------------------------------------------------------------ op11
def direct(x):
    """(n, S, explained, projections up to sign) of different integer vectors, by numpy's eigenvectors."""
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    y = u - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    return n, s, e / e.sum(), (x - s / n) @ v / np.sqrt(e)


def test_whitening_against_numpy(spark, sf):
    got = queries.QUERIES["op11_whitening"](spark, sf).toPandas().sort_values(["vec_id", "component"])
    rows = table(spark, sf, "embeddings").orderBy("vec_id").collect()
    x = np.floor(256 * np.array([r["embedding"] for r in rows], float)).astype(np.int64)
    n, s, explained, w = direct(x)
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    assert got["deviation"].to_numpy()[::4].tolist() == ((n * x - s) ** 2).sum(axis=1).tolist()
    assert np.allclose(got["explained"].to_numpy()[:4], explained[:4], rtol=1e-9)
    mine = got["whitened"].to_numpy().reshape(-1, 4)
    sign = np.sign((mine * w[:, :4]).sum(axis=0))
    assert np.allclose(mine, w[:, :4] * sign, atol=1e-8)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


@pytest.mark.parametrize("seed", range(4))
def test_charpoly_roots_and_null_spaces(spark, seed):
    r = np.random.default_rng(seed)
    a = r.integers(-9, 9, (12, 3 + 3 * seed))
    m = (a @ a.T).astype(object)                                       # rank below 12: zero roots
    c = whitening.charpoly(spark, m)
    for k in (-3, 0, 2, 7):                                            # det(kI - m), exactly, by fractions
        assert sum(v * k ** i for i, v in enumerate(c)) == determinant([[k * (i == j) - int(m[i, j]) for j in range(12)] for i in range(12)])
    e = np.linalg.eigvalsh(m.astype(float))[::-1]
    found = whitening.largest_roots(c, 3)
    assert [k for _, _, k in found] == [1, 1, 1]
    for (root, bits, k), want in zip(found, e):
        assert math.isclose(root / 2 ** bits, want, rel_tol=1e-10)
        v = whitening.null_space(m, root, bits, k)
        assert np.allclose(m.astype(float) @ v, want * v, atol=1e-9 * e[0])


def determinant(m):
    """Bareiss elimination: exact on integers."""
    m, sign, last = [list(r) for r in m], 1, 1
    for k in range(len(m) - 1):
        if m[k][k] == 0:
            swap = next((i for i in range(k + 1, len(m)) if m[i][k]), None)
            if swap is None:
                return 0
            m[k], m[swap], sign = m[swap], m[k], -sign
        for i in range(k + 1, len(m)):
            for j in range(k + 1, len(m)):
                m[i][j] = (m[i][j] * m[k][k] - m[i][k] * m[k][j]) // last
        last = m[k][k]
    return sign * m[-1][-1]


def test_whitening_edges(spark):
    axes = np.vstack([np.eye(6) * 3, -np.eye(6) * 3])                  # all roots equal: multiplicity six
    rows = [(i, v.tolist(), "x") for i, v in enumerate(axes)]
    rows += [(0, axes[0].tolist(), "x")] * 40                          # repeated rows: one vector of the fit, 41 rows out
    rows += [(None, [1.0, 2.0], "x"), (50, [1.0, 2.0], "x"), (51, None, "x"), (52, [float("nan")] * 6, "x"), (53, [], "x"),
             (54, [3.0, 5.0], "x"), (55, [float("inf"), 0.0], "x"), (56, [7.0], "x"), (57, [None, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").withColumnRenamed("component", "n")
    got = whitening.whiten(df).toPandas()
    six = got[got["vec_id"].between(0, 11)]
    assert len(six) == 52 * 4 and np.allclose(six["explained"], 1 / 6) and (six["identity_error"] < 1e-12).all()
    assert (got["vec_id"].isna()).sum() == 2 and set(got[got["vec_id"] == 50]["component"]) == {1, 2}
    two = got[(got["vec_id"] == 54) & (got["component"] == 2)]
    assert two["whitened"].isna().all() and (two["explained"] == 0).all()     # two points: no second variance
    assert len(got[got["vec_id"] == 56]) == 1 and got[got["vec_id"] == 56]["whitened"].isna().all()
    assert not set(got["vec_id"].dropna()) & {51, 52, 53, 55, 57}
    assert whitening.whiten(df.where("vec_id = 51")).count() == 0
    assert whitening.whiten(df.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_of_huge_entries_is_exact(spark):
    r = np.random.default_rng(2)
    x = [[int(v) for v in row] for row in r.integers(-(1 << 50), 1 << 50, (700, 3))]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df, components=1, scale=1).collect()}
    s = [sum(row[k] for row in x) for k in range(3)]
    assert got == {i: d for i, row in enumerate(x) if (d := sum((700 * v - t) ** 2 for v, t in zip(row, s)))}


# ------------------------------------------------------------------ op12
def runs_by_hand(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                seg = w[i:i + size]
                if not any(seg[d:] == seg[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i) + 1
    return sorted(out)


def random_words(r):
    n, k, out = r.choice([5, 10, 40, 100, 300]), r.choice([1, 2, 3, 5, 50]), []
    while len(out) < n:
        passage = [b"%d" % r.randrange(k) for _ in range(r.randint(1, r.choice([3, 10, 30, 60])))]
        out += (passage * r.randint(1, 7))[:-r.randint(1, len(passage))] if r.random() < .5 else passage[:10]
    return out


def test_runs_against_brute_force():
    r = random.Random(3)
    for _ in range(600):
        w = random_words(r)
        assert periodic.find_runs(w) == runs_by_hand(w)


def test_long_texts_with_long_periods():
    r = random.Random(4)
    w = [b"%d" % r.randrange(400) for _ in range(20_000)]
    assert periodic.find_runs((w[:4000] * 5)[:19_000] + w[:9]) == [(0, 19_000, 4000)]
    assert periodic.find_runs([b"a"] * 100_000) == [(0, 100_000, 1)]
    with pytest.raises(ValueError):
        periodic.find_runs(w, repeats=3)


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(words):
    runs = runs_by_hand(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(words) if i not in gone)).hexdigest())


def test_runs_query_against_brute_force(spark, sf):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, sf).collect()}
    docs = [r for r in table(spark, sf, "documents").select("doc_id", "text").collect() if len((r["text"] or "").split()) < 1500]
    assert len(docs) > 150 and any(v[0] for v in got.values())
    for r in docs:
        assert got[r["doc_id"]] == digest(planted(r["doc_id"], r["text"])), r["doc_id"]


def test_runs_edges(spark, tmp_path):
    rows = [(None, "a b " * 9, "en", "s"), (1, None, "en", "s"), (2, "", None, None), (3, " \t\n", "en", "s"), (4, "é é é é é é", "en", "s"),
            (4, "é é é é é é", "en", "s"), (5, "x x x", "en", "s"), (6, "w " * 60_000, "en", "s")]
    df = docs_frame(spark, rows, extra=("runs", "collapsed", "words"))
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.detect(df).collect())
    assert got == sorted([("None", 18, [(0, 18, 2)], "a b"), ("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""), ("4", 6, [(0, 6, 1)], "é"),
                          ("4", 6, [(0, 6, 1)], "é"), ("5", 2, [], "x x x"), ("6", 60_000, [(0, 60_000, 1)], "w")])
    assert periodic.detect(df.limit(0)).count() == 0
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows_ = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    for r in rows_:
        if r["doc_id"] != 6:
            text = next(t for i, t, _, _ in rows if i == r["doc_id"])
            assert tuple(r)[1:] == digest(planted(r["doc_id"], text))


# ------------------------------------------------------------------ op13
def test_gradients_are_those_of_the_loss():
    net = bytecnn.Net(seed=3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    r = random.Random(5)
    texts = [bytes(r.randrange(32, 127) for _ in range(n)) for n in (5, 40, 300, 700)]
    labels, weights = np.array([1, 0, 1, 0]), np.array([1.0, 2.0, 0.5, 1.0])
    _, grad = net.gradients(texts, labels, weights)
    rng = np.random.default_rng(1)
    for k, p in net.p.items():
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(6)]:
            if k == "embed":
                at = (texts[2][int(at[0])], at[1])
            kept, eps = p[at], 1e-4
            p[at] = kept + eps
            up = net.gradients(texts, labels, weights)[0]
            p[at] = kept - eps
            down = net.gradients(texts, labels, weights)[0]
            p[at] = kept
            assert abs((up - down) / (2 * eps) - grad[k][at]) < 2e-3 * (1 + abs(grad[k][at])), (k, at)


def test_features_are_the_definition():
    """Filters, chunks and maxima written out for one text."""
    net = bytecnn.Net(seed=9)
    r = random.Random(6)
    for n in (0, 1, 100, 128, 129, 500):
        raw = bytes(r.randrange(256) for _ in range(n))
        codes = list(raw) + [bytecnn.PAD] * (bytecnn.WIDTH + bytecnn.HOP)
        value = [np.concatenate([net.p["embed"][c] for c in codes[i:i + bytecnn.WIDTH]]) @ net.p["conv"] for i in range(max(n, 1))]
        starts = [0] if n <= 128 else [*range(0, n - 128, 128), n - 128]
        blocks = [np.max(value[s:s + 128], axis=0) for s in starts]
        chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:])] or blocks
        want = np.max([np.maximum(np.maximum(c + net.p["conv_b"], 0) @ net.p["dense"] + net.p["dense_b"], 0) for c in chunks], axis=0)
        assert np.allclose(net.features(raw), want, atol=1e-4)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r["doc_id"]: r for r in bytecnn.score(docs, labels, epochs=12).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(got) == docs.count()
    out = [(got[i]["predicted"], y) for i, y in truth.items() if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (fold(i, 5) == 0) for i in got) and len(out) > 40
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert np.mean([p == y for p, y in out]) > 0.9


def test_quality_edges(spark):
    good = "the plain words of a text that says one thing after another, in order and without noise. "
    rows = [(i, (good * 3)[r_:r_ + 150] if i % 2 else "JUNK!! " * (10 + i), "en", "s") for i, r_ in ((i, i % 37) for i in range(120))]
    rows += [(None, good, "en", "s"), (500, None, None, None), (501, "", "en", "s"), (502, good * 4000, "en", "s"), (3, rows[3][1], "en", "s")]
    df = docs_frame(spark, rows, extra=("score", "y", "at"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (7, None, 0), (5, 1, 0), (900, 0, 0)], "doc_id long, quality int, toxic int")
    got = bytecnn.score(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["score"] is None} == set()
    judged = [(r["predicted"], r["doc_id"] % 2) for r in got if r["doc_id"] is not None and r["doc_id"] < 120 and r["held_out"]]
    assert np.mean([p == y for p, y in judged]) > 0.9
    one = bytecnn.score(df, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0][0] > 0.99                               # a single class: its share
    none = bytecnn.score(df, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    assert bytecnn.score(df.limit(0), labels).count() == 0


def test_groups_of_blocks_change_nothing(monkeypatch):
    net = bytecnn.Net(seed=9)
    raw = bytes(random.Random(8).randrange(97, 120) for _ in range(5000))
    whole = net.features(raw)
    monkeypatch.setattr(bytecnn, "GROUP", 3)
    assert np.allclose(net.features(raw), whole, atol=1e-4)
