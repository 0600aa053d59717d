"""Operators over the whole corpus, against brute force on small tables."""

import math
import random

import numpy as np
import pytest
import xxhash
from helpers import ascii_words, components, docs_frame, fold, later_lines, mix_by_hand
from pyspark.sql import functions as F

import __spark_entry__ as E
from curata.llm import langid, licenses, linededup, lmscore, mixing, rpforest, simhash

SAMPLE = [
    (0, "the cat sat on the mat and looked at the dog", "en", "a"), (1, "the cat sat on the mat and looked at the dog", "en", "b"),
    (2, "der Hund liegt auf der Matte und schläft", "de", None), (3, None, "en", "a"), (4, "", None, "a"), (5, " \n\t", "de", "b"),
    (6, "123 456 !!!", "en", "a"), (None, "null id text here", "en", "a"), (7, "word", "en", ""), (7, "word", "en", ""),
    (8, "many words " * 4000, "en", "b"), (9, "x" * 60000, "en", "c"),
]
CLASH = ("fp", "root", "mark", "size", "words", "n_lines", "text_in", "learn", "copy", "gone")


def fingerprint(text, width):
    words = ascii_words(text)
    if not words:
        return 0
    grams = [b" ".join(words[k:k + width]) for k in range(len(words) - width + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check_simhash(rows, got, width=4, bits=4):
    prints = [fingerprint(t, width) for _, t in rows]
    root = components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= bits)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = sorted(((-1 if i is None else i), f"{p:016x}", least.get(root[p], -1)) for (i, _), p in zip(rows, prints))
    assert sorted(((-1 if g["doc_id"] is None else g["doc_id"]), g["fingerprint"], -1 if g["component_id"] is None else g["component_id"])
                  for g in got) == want


def test_simhash_on_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_simhash(rows, E.queries()["op8_simhash"](spark, sf).collect())


def test_simhash_chains_and_families(spark):
    rng, rows = random.Random(5), []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            rows.append(base)
            for _ in range(rng.randint(0, 3)):
                base ^= 1 << rng.randrange(64)
    signed = [x - (1 << 64) if x >> 63 else x for x in rows]
    fam = {r["fp"]: r["root"] for r in simhash.families(spark.createDataFrame([(x,) for x in signed], "fp long"), 4)[0].collect()}
    root = components(sorted(set(rows)), lambda a, b: (a ^ b).bit_count() <= 4)
    mine = {x: fam.get(s, s) for x, s in zip(rows, signed)}
    pairs = {(root[x], mine[x]) for x in rows}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_simhash_edge_cases(spark):
    d = docs_frame(spark, SAMPLE, extra=CLASH)
    check_simhash([(r[0], r[1]) for r in SAMPLE], simhash.near_duplicates(d).collect())
    assert simhash.near_duplicates(d.limit(0)).collect() == []
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    got = kept.collect()
    comp = {r["component_id"] for r in simhash.near_duplicates(d).collect()}
    assert len(got) == len(comp) and sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(c for c in comp if c is not None)
    assert simhash.keep_one(d.limit(0)).collect() == []


def golden(k):
    step = (mixing.GOLDEN * (1 << 20)) % 1.0
    part = (k >> 20) * step
    x = (part - math.floor(part)) + (k & ((1 << 20) - 1)) * mixing.GOLDEN
    return x - math.floor(x)


def check_mix(spark, d, rows, weights=(1, 2, 3), cap=3, block=64):
    """rows: (doc_id, text, source) with different texts or ids."""
    from pyspark.sql import functions as F
    key = {(r["doc_id"], r["text"], r["source"]): r["h"] for r in d.select("doc_id", "text", "source", F.xxhash64(
        F.lit("shuffle"), mixing.row_mark(F.col("doc_id"), F.col("source"), F.col("text")), F.lit(1)).alias("h")).collect()}
    by_hand = mix_by_hand([(s, len(ascii_words(t)), (i, t, s)) for i, t, s in rows], weights, cap, block, lambda k: key[k], golden)
    got = mixing.taken(mixing.mix(d, weights, cap, block)).collect()
    want = []
    for i, t, s in rows:
        target, taken = by_hand[s]
        n = sum(len(ascii_words(b)) for a, b, c in rows if c == s)
        want.append(((-1 if i is None else i), len(ascii_words(t)), n, round(target, 6), taken.get((i, t, s), 0)))
    assert sorted(((-1 if g["doc_id"] is None else g["doc_id"]), g["size"], g["source_size"], round(g["target"], 6), g["taken"]) for g in got) == sorted(want)
    return got


def test_mix_on_documents(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = check_mix(spark, d, [(r["doc_id"], r["text"], r["source"]) for r in d.collect()])
    by = {}
    for g in got:
        by.setdefault((g["source_size"], g["target"]), []).append(g["taken"])
        assert g["taken"] <= 3 * g["size"]
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 4 * 64


def test_mix_edge_cases(spark):
    rows = [r for k, r in enumerate(SAMPLE) if k != 9]
    d = docs_frame(spark, rows, extra=CLASH)
    check_mix(spark, d, [(r[0], r[1], r[3]) for r in rows])
    full = docs_frame(spark, SAMPLE, extra=CLASH)
    mixed = mixing.apply_mix(full)
    assert mixed.columns == full.columns
    m = mixing.taken(mixing.mix(full)).collect()
    assert len(m) == len(SAMPLE)
    assert sum(len(ascii_words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in m)
    assert mixing.taken(mixing.mix(d.limit(0))).collect() == [] and mixing.apply_mix(d.limit(0)).collect() == []
    empty = docs_frame(spark, [(1, None, "en", "a"), (2, " ", None, None)])
    assert [r["taken"] for r in mixing.taken(mixing.mix(empty)).collect()] == [0, 0]


def test_line_dedup_on_documents(spark, sf):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())[:120]
    check_lines(spark, rows)


def check_lines(spark, rows, t=0.8):
    d = docs_frame(spark, [(i, x, "en", "s") for i, x in rows], extra=CLASH)
    got = linededup.dedup(d, t)
    assert got.columns == [c for c in d.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    gone = later_lines(rows, t)
    want = sorted((i, None if x is None else "\n".join(line for k, line in enumerate(x.split("\n")) if (r, k) not in gone))
                  for r, (i, x) in enumerate(rows))
    assert sorted((g["doc_id"], g["text"]) for g in got.collect()) == want
    assert sum(g["n_removed"] for g in got.collect()) == len(gone)


def test_line_dedup_families(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        lines = []
        for _ in range(3):
            line = rng.sample(vocab, rng.randint(1, 14)) if rng.random() < 0.6 or not rows else (rng.choice(rows)[1].split("\n")[0].split() or ["z"])
            if rng.random() < 0.5:
                line = line[:] + [rng.choice(vocab)]
            rng.shuffle(line)
            lines.append(" ".join(line) if rng.random() < 0.95 else "")
        rows.append((k, "\n".join(lines)))
    check_lines(spark, rows)


def test_line_dedup_blanks(spark):
    rows = [(1, "a b c\n\t\x0c"), (2, "\x0ba\tb  c\r\nd e"), (3, "c\x0bb\x0ca \n \r\n\x0bd\te\t\nf\x0bg"), (4, "\x0b"), (5, "f\u00a0g\nz\ty\nz y")]
    check_lines(spark, rows)
    d = docs_frame(spark, [(i, x, "en", "s") for i, x in rows])
    got = {g["doc_id"]: (g["text"], g["n_lines"], g["n_removed"]) for g in linededup.dedup(d).collect()}
    assert got == {1: ("a b c\n\t\x0c", 1, 0), 2: ("d e", 2, 1), 3: (" \r\nf\x0bg", 3, 2), 4: ("\x0b", 0, 0), 5: ("f\u00a0g\nz\ty", 3, 1)}
    d = d.select(F.col("doc_id").alias("doc"), F.xxhash64("doc_id").alias("mark"), F.lit("k l\tm").alias("text")).where("doc < 3").union(
        spark.createDataFrame([(7, 7, "\x0bk\tl m \r")], "doc long, mark long, text string"))
    classes, _, _ = linededup.matches(d)               # lines that differ in blanks alone are one class
    assert [(r["doc"], r["n"]) for r in classes.collect()] == [(1, 3)]


def test_line_dedup_removes_by_few_classes(spark, monkeypatch):
    sizes, real = {}, linededup.written

    def seen(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(linededup, "written", seen)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(10)) + ("\na line that stands in many texts" if k < 9 else "")) for k in range(30)]
    rows.append((30, rows[4][1].split("\n")[0] + " more"))
    check_lines(spark, rows)
    assert sizes["line-state"] == 2                    # of 32 classes: the copied line and the near copy


def test_line_dedup_parity_bounds_the_difference(spark):
    rng = random.Random(8)
    lines = [" ".join(rng.choices([f"v{j}" for j in range(40)], [1 / (j + 1) for j in range(40)], k=rng.randint(1, 120))) for _ in range(60)]
    d = spark.createDataFrame([(k, k, x) for k, x in enumerate([*lines, lines[0]])], "doc long, mark long, text string")
    classes = {r["doc"]: r for r in linededup.matches(d)[0].collect()}
    assert classes[0]["copies"] == 2 and sum(r["copies"] for r in classes.values()) == 61
    for i, x in classes.items():
        for j, y in classes.items():
            bits = sum(((x[p] ^ y[p]) & (1 << 64) - 1).bit_count() for p in ("parity", "parity2"))
            assert bits <= len(set(lines[i].split()) ^ set(lines[j].split()))
    assert any(r["parity"] for r in classes.values()) and any(r["parity2"] for r in classes.values())


def test_line_dedup_edge_cases(spark):
    d = docs_frame(spark, SAMPLE, extra=CLASH)
    got = linededup.dedup(d).collect()
    assert len(got) == len(SAMPLE)
    by = {}
    for g in got:
        by.setdefault(g["doc_id"], []).append(g)
    assert by[1][0]["text"] == "" and by[3][0]["text"] is None and by[5][0]["text"] == " \n\t"
    assert sorted(g["n_removed"] for g in by[7]) == [0, 1]
    assert linededup.dedup(d.limit(0)).collect() == []
    kept = linededup.keep_new(d)
    assert kept.columns == d.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 0, 2, 3, 4, 5, 6, 7, 8, 9]


def pairwise_lm(rows, weights_of):
    """Counts by hand: returns (total, kinds, unigrams, bigrams) over learning rows."""
    uni, bi = {}, {}
    for i, t in rows:
        if fold(i, 5) != 1:
            words = [*ascii_words(t), b""]
            for v, w in zip([b"", *words], words):
                uni[w] = uni.get(w, 0) + 1
                bi[v, w] = bi.get((v, w), 0) + 1
    return uni, bi


def check_lm(rows, got, weights):
    uni, bi = pairwise_lm(rows, weights)
    total, kinds = sum(uni.values()), len(uni)
    want = []
    for i, t in rows:
        words = [*ascii_words(t), b""]
        base = score = 0.0
        for v, w in zip([b"", *words], words):
            c = uni.get(w, 0)
            base += math.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
            cv = uni.get(v, 0)
            a, b, z = weights[int(math.log2(cv)) + 1 if cv else 0]
            score += math.log10(a * (bi.get((v, w), 0) / cv if cv else 0) + b * (c / total if total else 0) + z / (kinds + 1))
        want.append((-1 if i is None else i, fold(i, 5) == 1, len(words), sum(w in uni for w in words), total, round(base, 5), round(score, 5)))
    mine = [(-1 if g["doc_id"] is None else g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"],
             round(g["base_score"], 5), round(g["score"], 5)) for g in got]
    for x, y in zip(sorted(mine), sorted(want), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-6, abs=1e-4)


@pytest.fixture
def seen_weights(monkeypatch):
    kept = []
    real = lmscore.learn_weights
    monkeypatch.setattr(lmscore, "learn_weights", lambda *a: kept.append(real(*a)) or kept[-1])
    return kept


@pytest.mark.parametrize("small", [False, True])
def test_lm_scores_on_documents(spark, sf, seen_weights, monkeypatch, small):
    if small:
        monkeypatch.setattr(lmscore, "SHARD_ENTRIES", 2000)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = E.queries()["op5_lm_scoring"](spark, sf).collect()
    check_lm(rows, got, seen_weights[-1])
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_lm_weights_raise_the_likelihood():
    import pandas as pd
    cells = pd.DataFrame({"bucket": [1, 1, 1], "n": [50, 30, 20], "p2": [25.0, 0.0, 2.0], "p1": [5.0, 3.0, 0.0]})
    w = lmscore.learn_weights(cells, 0.01)[1]
    p = np.array([[0.5, 0.1, 0.01], [0.0, 0.1, 0.01], [0.1, 0.0, 0.01]])

    def likelihood(w):
        return float((np.array([50, 30, 20]) * np.log(p @ w)).sum())
    grid = [np.array([a, b, 1 - a - b]) for a in np.arange(0.01, 1, 0.01) for b in np.arange(0.01, 1 - a, 0.01)]
    assert likelihood(w) >= max(map(likelihood, grid)) - 1e-3


def test_lm_edge_cases(spark, seen_weights):
    d = docs_frame(spark, SAMPLE, extra=CLASH)
    got = lmscore.score(d).collect()
    check_lm([(r[0], r[1]) for r in SAMPLE], got, seen_weights[-1])
    assert lmscore.score(d.limit(0)).collect() == []
    none = docs_frame(spark, [(i, "a b", "en", "s") for i in range(40) if fold(i, 5) == 1])
    assert all(math.isfinite(g["score"]) and g["train_tokens"] == 0 for g in lmscore.score(none).collect())


def test_language_on_documents(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in E.queries()["op4_language_id"](spark, sf).collect()}
    rows = d.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    assert all(got[r["doc_id"]]["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= got[r["doc_id"]]["score"] <= 1 for r in rows)
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_kneser_ney_matches_the_definition():
    texts = {"x": ["abab ba", "bba"], "y": ["cab ccab"]}
    counts, grams = {}, {}
    for lang, own in texts.items():
        c = {}
        for t in own:
            s = [langid.PAD] * (langid.ORDER - 1) + langid.fold(t).tolist()
            for k in range(len(s) - langid.ORDER + 1):
                g = tuple(s[k:k + langid.ORDER])
                c[g] = c.get(g, 0) + 1
        grams[lang] = c
        counts[lang] = (np.array(list(c), np.uint32), np.array(list(c.values())))
    m = langid.Models(["x", "y"], counts)
    letters = {g[-1] for c in grams.values() for g in c}

    def by_hand(lang):
        table = {langid.ORDER: grams[lang]}
        for n in range(langid.ORDER - 1, 0, -1):
            low = {}
            for g in table[n + 1]:
                low[g[1:]] = low.get(g[1:], 0) + 1
            table[n] = low

        def p(g):
            n = len(g)
            if not n:
                return 1 / (len(letters) + 1)
            t = table[n]
            one, two = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
            d = one / (one + 2 * two) if one and two else 0.5
            own = {h: v for h, v in t.items() if h[:-1] == g[:-1]}
            if not own:
                return p(g[1:])
            total = sum(own.values())
            return max(own.get(g, 0) - d, 0) / total + d * len(own) / total * p(g[1:])
        return p

    for text in ("abba cab", "zzz", "b", "cabba bacc a"):
        s = [langid.PAD] * (langid.ORDER - 1) + langid.fold(text).tolist()
        want = [sum(math.log(by_hand(lang)(tuple(s[k:k + langid.ORDER]))) for k in range(len(s) - langid.ORDER + 1)) for lang in ("x", "y")]
        assert m.total(langid.fold(text)) == pytest.approx(want, rel=1e-4)


def test_language_edge_cases(spark):
    d = docs_frame(spark, SAMPLE, extra=CLASH + ("lang_pred", "score"))
    got = langid.identify(d).collect()
    assert len(got) == len(SAMPLE)
    for g in got:
        text = next(t for i, t, _, _ in SAMPLE if i == g["doc_id"])
        assert (g["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= g["score"] <= 1
    kept = langid.keep_identified(d)
    assert kept.columns == d.columns
    assert langid.identify(d.limit(0)).collect() == []
    nobody = docs_frame(spark, [(1, "no label", None, "s"), (2, None, None, None)])
    assert {g["lang_pred"] for g in langid.identify(nobody).collect()} == {"und"}
    assert langid.fold("  A1bÉ--ß ").tolist() == [ord(c) for c in "a bé ß"]


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))


def check_nearest(rows, got, every, k=5):
    """Ranks and scores are right for what was found; returns the recall."""
    by = {}
    for g in got:
        by.setdefault(g["query_id"], []).append(g)
    vec, hit, all_ = dict(rows), 0, 0
    for q in sorted({i for i, _ in rows if i % every == 0}):
        best = sorted((-round(cosine(vec[q], v), 12), i) for i, v in rows if i != q)[:k]
        mine = sorted(by.get(q, []), key=lambda g: g["rank"])
        assert [g["rank"] for g in mine] == list(range(1, len(best) + 1))
        assert [(-g["score"], g["vec_id"]) for g in mine] == sorted((-g["score"], g["vec_id"]) for g in mine)
        for g in mine:
            assert g["vec_id"] != q and g["score"] == pytest.approx(cosine(vec[q], vec[g["vec_id"]]), abs=1e-12)
        floor = best[-1][0] if best else 0
        hit += sum(-round(g["score"], 12) <= floor for g in mine)
        all_ += len(best)
    return hit / max(all_, 1)


def test_forest_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = E.queries()["op2_rp_forest"](spark, sf).collect()
    assert check_nearest(rows, got, 50) >= 0.9


def test_forest_edge_cases(spark):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    rows = list(enumerate(base + [base[0]] * 40 + [[2 * x for x in base[1]]]))
    bad = [(200, None), (250, [0.0] * 8), (300, [float("nan")] + [1.0] * 7), (350, [float("inf")] * 8), (400, [1.0]), (450, [None] + [1.0] * 7), (None, base[2])]
    schema = "vec_id long, embedding array<double>, v string, cls string"
    d = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + bad + [rows[5]]], schema)
    got = rpforest.nearest(d, d["vec_id"] % 50 == 0).collect()
    assert check_nearest(rows, got, 50) == 1.0
    assert rpforest.nearest(d.limit(0), d["vec_id"] % 50 == 0).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (1, [1.0, 1.0], "", "")], schema)
    assert [(r["query_id"], r["vec_id"], r["rank"]) for r in rpforest.nearest(few, few["vec_id"] == 0).collect()] == [(0, 1, 1)]


def test_license_scan_matches_brute_force(spark):
    files = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "just words\nof text"), (3, "a/b/LICENSE.txt", "nothing to see"),
        (4, "a/b/d/COPYING", "Licensed under the Apache License, Version 2.0."), (5, "a/b/d/e/f.c", None), (6, "x.py", "All rights reserved."),
        (7, None, "This work is licensed under the GNU General Public License, version 3."), (8, "q/r.txt", ""), (9, "a/b/d/e/f.c", "Licensed under CC BY-NC 4.0.\n\nwords"),
        (10, "a/LICENSE-CC", "Licensed under CC BY 4.0."), (None, "a/z", "word " * 50000), (11, "a/multi.c", "Licensed under the Apache License,\nVersion 2.0."),
    ]
    d = spark.createDataFrame([(*f, "x", "y") for f in files], "doc_id long, path string, text string, license string, folder string")
    got = {(r["file_id"], r["path"]): r for r in licenses.scan(d).collect()}
    assert len(got) == len(files)

    bags = [[w for row in licenses.words_of(t) for w in row] for _, t in licenses.TEMPLATES]
    lines = [row for _, _, t in files for row in licenses.words_of(t or "") if row]
    vocab = {w for b in bags for w in b}
    idf = {w: math.log((1 + len(lines)) / (1 + sum(w in row for row in lines))) + 1 for w in vocab}
    other = math.log((1 + len(lines)) / 2) + 1

    def vector(words):
        v, rest = {}, 0
        for w in words:
            if w in vocab:
                v[w] = v.get(w, 0) + idf[w]
            else:
                rest += 1
        return v, math.sqrt(sum(x * x for x in v.values()) + rest * other * other)

    tv = [vector(b) for b in bags]
    for _, path, text in files:
        rows = licenses.words_of(text or "")
        units, block = [r for r in rows if r], []
        for row in rows + [[]]:
            if row:
                block += row
            else:
                units.append(block)
                block = []
        best = max((sum(x * v.get(w, 0) for w, x in t.items()) / n / max(m, 1e-9) for u in units if u for v, m in [vector(u)] for t, n in tv), default=0)
        assert any(r["score"] == pytest.approx(best, abs=1e-8) for k, r in got.items() if k[1] == path)
    assert got[2, "a/b/c/x.py"]["inherited"] == "MIT" and got[2, "a/b/c/x.py"]["inherited_from"] == "a"
    assert got[5, "a/b/d/e/f.c"]["effective"] == "Apache-2.0" and got[9, "a/b/d/e/f.c"]["effective"] == "CC-BY-NC-4.0"
    assert got[6, "x.py"]["effective"] == "Proprietary" and got[7, None]["effective"] == "GPL-3.0" and got[8, "q/r.txt"]["effective"] is None
    assert got[11, "a/multi.c"]["license"] == "Apache-2.0"
    assert licenses.scan(d.limit(0)).collect() == []


def test_license_scan_on_documents(spark, sf):
    got = {r["doc_id"]: r for r in E.queries()["op1_license_scan"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        says = {n for n, t in licenses.TEMPLATES if t in r["text"].split("\n")}
        if says:
            assert got[r["doc_id"]]["license"] in says


@pytest.mark.parametrize("common", [0, 6, 10_000])
def test_license_words_outside_templates_have_their_own_counts(spark, common):
    rng = random.Random(5)
    pool = ["jane", "doe", "by", "acme", "2021", "corp", "zzz", "yyy", "the", "of", "license", "under"]
    texts = ["\n".join(" ".join(rng.choices(pool, range(1, len(pool) + 1), k=rng.randint(1, 9))) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts += ["Released under the MIT License by Jane Doe.", "Copyright (c) 2021 Acme Corp. All rights reserved.", "\n\nLicensed under the\nApache License, by Jane\n\nx"] * 2
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("path", F.lit("x"))
    got = {r["file_id"]: r for r in licenses.scan(d, common=common).collect()}
    lines = [row for t in texts for row in licenses.words_of(t) if row]

    def vector(words):
        return {w: words.count(w) * (math.log((1 + len(lines)) / (1 + sum(w in row for row in lines))) + 1) for w in set(words)}

    def cosine(a, b):
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    marks = [(n, vector(sum(licenses.words_of(t), []))) for n, t in licenses.TEMPLATES if not t.startswith(licenses.SPDX)]
    for k, text in enumerate(texts):
        rows = licenses.words_of(text)
        units, block = [r for r in rows if r], []
        for row in [*rows, []]:
            if not row and block:
                units.append(block)
            block = block + row if row else []
        score = max(cosine(vector(u), m) for u in units for _, m in marks)
        assert got[k]["score"] == pytest.approx(score, abs=1e-8)
        assert (got[k]["license"] is not None) == (got[k]["score"] >= 0.6)


def test_license_near_pairs_get_their_own_names(spark):
    gnu = ("This {} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\n"
           "the Free Software Foundation{} either version {} of the License, or\n(at your option) any later version.")
    says = [("GPL-2.0", gnu.format("program", ";", "", ";", "2")), ("GPL-3.0", gnu.format("program", ":", "", ",", "3")),
            ("LGPL-2.1", gnu.format("library", ";", "Lesser ", ";", "2.1")), ("LGPL-3.0", gnu.format("library", ":", "Lesser ", ",", "3")),
            ("AGPL-3.0", gnu.format("program", ":", "Affero ", ",", "3"))]
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        says += [(f"CC-{kind}-4.0", f"Licensed under CC {kind} 4.0."), (f"CC-{kind}-4.0", f"CC {kind} 4.0"), (f"CC-{kind}-4.0", f"// SPDX-License-Identifier: CC-{kind}-4.0")]
    says += [(n, f"# SPDX-License-Identifier: {n}{x}") for n in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for x in ("", "-only", "-or-later")]
    says += [(n, f"/* SPDX-License-Identifier: {n} */") for n in ("MIT", "Apache-2.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC0-1.0", "Unlicense")]
    says += [(None, "SPDX-License-Identifier: Zlib"), (None, "SPDX-License-Identifier: EPL-2.0")]
    bsd = ("Redistribution and use in source and binary forms, with or without modification,\nare permitted provided that the following conditions are met:\n\n"
           "1. Redistributions of source code must retain the above copyright notice.\n\n")
    says += [("BSD-2-Clause", bsd), ("BSD-3-Clause", bsd + "3. Neither the name of the copyright holder nor the names of its contributors\nmay be used to endorse or promote "
                                     "products derived from this software without\nspecific prior written permission.")]
    plain = [(None, f"nothing but words {k}") for k in range(300)]
    d = spark.createDataFrame([(k, "x", t) for k, (_, t) in enumerate(says + plain)], "doc_id long, path string, text string")
    got = {r["file_id"]: r["license"] for r in licenses.scan(d).collect()}
    assert [(says[k][1], got[k]) for k in range(len(says))] == [(t, n) for n, t in says]


def test_license_scan_returns_every_licence(spark):
    apache = "Licensed under the Apache License,\nVersion 2.0."
    files = [(0, "a/LICENSE", f"Released under the MIT License.\n\nwords\n\n{apache}"), (1, "a/LICENSE-CC", "Licensed under CC BY 4.0."), (2, "a/b/x.py", "nothing"),
             (3, "c/x.py", "// SPDX-License-Identifier: MIT OR Apache-2.0"), (4, "c/y.py", "Licensed under the Apache License, Version 2.0."),
             (5, "c/z.py", "Released under the MIT License.\nLicensed under CC BY-NC 4.0.")]
    d = spark.createDataFrame(files + [(k, None, f"just words {k}") for k in range(10, 200)], "doc_id long, path string, text string")
    got = {r["file_id"]: r for r in licenses.scan(d).collect()}
    every = {k: [(x["license"], x["line"]) for x in got[k]["licenses"]] for k in range(6)}
    assert every[0] == [("MIT", 1), ("Apache-2.0", 5)] and every[1] == [("CC-BY-4.0", 1)] and every[2] == []
    assert sorted(every[3]) == [("Apache-2.0", 1), ("MIT", 1)] and every[4] == [("Apache-2.0", 1)] and sorted(every[5]) == [("CC-BY-NC-4.0", 2), ("MIT", 1)]
    for k in (0, 1, 3, 4, 5):
        first = got[k]["licenses"][0]
        assert (first["license"], first["score"], first["line"]) == (got[k]["license"], got[k]["score"], got[k]["license_line"])
    assert got[2]["inherited"] == "MIT" and got[2]["inherited_licenses"] == ["Apache-2.0", "CC-BY-4.0", "MIT"]


def test_forest_ties_go_to_the_smallest_ids(spark):
    rng = random.Random(9)
    base = [rng.gauss(0, 1) for _ in range(8)]
    hot = [[float(j == i % 8) for j in range(8)] for i in range(16)]
    scaled = [(1000 - i, [x * 2.0 ** (i % 40) * (1 + i // 40) for x in base]) for i in range(300)]
    near = [(i, [x + 1e-5 * rng.gauss(0, 1) for x in base]) for i in range(2000, 2060)]
    ones = [(3000 + i, [x * (1 + i) for x in v]) for i, v in enumerate(hot)]
    pairs = [(4000 + i, [float(j in (0, 1 + i % 7)) * (i + 1) for j in range(8)]) for i in range(140)]
    rows = scaled + near + ones + pairs
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rpforest.nearest(d, F.col("vec_id").isin(1000, 3000, 3003, 4000), k=5, search=50.0).collect()
    vec = dict(rows)

    def exact(a, b):
        def dot(x, y):
            out = 0.0
            for i, j in zip(x, y):
                out += i * j
            return out
        return dot(a, b) / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b)))

    for q in (1000, 3000, 3003, 4000):
        mine = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        best = sorted((-exact(vec[q], v), i) for i, v in rows if i != q)[:5]
        assert mine == [(i, -s) for s, i in best]


def test_forest_queries_of_a_leaf_are_split(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    every = F.col("vec_id") % 2 == 0
    whole = rpforest.nearest(d, every).collect()
    split = rpforest.nearest(d, every, part_rows=20, ask_rows=30)
    assert sorted(split.collect()) == sorted(whole) and len(whole) == 1000
    assert "share" in split._jdf.queryExecution().analyzed().toString()


def test_forest_of_several_lengths(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4 if i % 3 else 6)]) for i in range(300)] + [(300, [1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rpforest.nearest(d, F.col("vec_id") % 50 == 0).collect()
    for n in (4, 6):
        own = [(i, v) for i, v in rows if len(v) == n]
        asked = {i for i, _ in own if i % 50 == 0}
        assert asked and check_nearest(own, [g for g in got if g["query_id"] in asked], 50) == 1.0
    assert not [g for g in got if g["query_id"] == 300]


def test_language_samples_of_rows_that_share_an_id(spark):
    """Null or equal ids do not bring all rows into the sample or none."""
    docs = spark.createDataFrame([(None if k % 2 else 7, f"text number {k}", "en") for k in range(4000)], "doc_id long, text string, lang string")
    for salt in ("teach", "calibrate"):
        for d in (docs, docs.where("doc_id IS NULL"), docs.where("doc_id = 7")):
            assert 250 < langid._sampled(d, 300, salt).count() < 350
    mixed = [(None, ("the house of the king and the queen " if k % 2 else "das haus und der garten sind nicht gross ") + str(k), "en" if k % 2 else "de") for k in range(400)]
    got = langid.identify(spark.createDataFrame(mixed, "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in got.collect()} == {"en", "de"}
