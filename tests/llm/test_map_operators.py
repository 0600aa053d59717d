"""Operators that judge each document by itself: tokens, personal data, fingerprints."""

import base64
import hashlib
import random
import re
import time
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from helpers import docs_frame

import __spark_entry__ as E
from pyspark.sql import functions as F

from curata.llm import bpe, merkle, pii

TEXTS = [
    None, "", " ", "\n\n", "a", "Hello  world, it's 2024!", "naïve café — 日本語 \U0001f600 x", "x" * 5000, "ab " * 3000 + "\n" * 50,
    "don't DON'T we'll\t\ttabs\r\nlines ", "Hello  world, it's 2024!", "é" * 700 + "   end",
]


def frame(spark, texts=TEXTS, extra=()):
    return docs_frame(spark, [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, "null id", None, None), (3, "again", "en", "s")], extra)


@pytest.fixture(scope="module")
def codec():
    return bpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def tik():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_rejects_strangers(codec):
    h = codec.hash
    assert sorted(h.key_at) == list(range(len(codec.tokens)))
    assert list(h.find(codec.tokens)) == list(range(len(codec.tokens)))
    assert (h.find([t + b"\x00\x01zz" for t in codec.tokens[:2000]]) == -1).all()


def test_bpe_matches_the_library_on_documents(spark, sf, codec, tik):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in E.queries()["op7_byte_bpe"](spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = tik.encode_ordinary(r["text"] or "")
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_bpe_edge_texts_and_round_trip(spark, codec, tik):
    d = frame(spark, extra=("ids", "text_in", "decoded"))
    out = bpe.decode(bpe.encode(d, codec), codec)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "text_in", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r["ids"] == tik.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.round_trip(d.limit(0), codec).collect() == []


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = {"email": [m.span() for m in EMAIL.finditer(text)],
           "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]}
    digits = lambda s: re.sub("[^0-9]", "", s)
    out["card"] = [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


def check_pii(rows, got):
    assert len(rows) == len(got)
    for (_, text), g in zip(rows, got):
        want = base_spans(text)
        shown = [f"{k}:{a}:{b}" for k, spans in want.items() for a, b in spans]
        assert [g["n_email"], g["n_ip"], g["n_card"], g["n_phone"]] == [len(v) for v in want.values()], text
        assert g["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest(), (text, g["spans"], shown)
        assert set(shown) <= set(g["spans"].split(",")) or not shown


def test_pii_matches_brute_force_on_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = E.queries()["op10_pii"](spark, sf).orderBy("doc_id").collect()
    check_pii(rows, got)
    assert sum(g["n_email"] + g["n_ip"] + g["n_card"] + g["n_phone"] for g in got) > 0


def test_pii_edge_cases(spark):
    texts = [
        None, "", "a@b.cc_d@e.f", "x@y@z.com", "a@b.c@d.e", ".%a-@b-.c.d..e", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 00.0.0.000",
        "4111 1111 1111 1111", "4111-1111-1111-1111 7", "4111  1111", "+1 (212) 555-1234.", "+49 30 123", "+1+2125551234", "\U0001f600 me@x.org é 10.0.0.1",
        "IBAN DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "my ssn is 078-05-1120", "no 078-05-1120",
        "a" * 200_000, "a." * 50_000 + "@" + "b." * 50_000 + "c", "1" * 50_000, "1 " * 40_000, "+1" + "(" * 50_000, "me@x.org " * 1500,
    ]
    d = docs_frame(spark, [(k, t, None, None) for k, t in enumerate(texts)], extra=("spans", "found", "score"))
    got = pii.summary(d).orderBy("doc_id").collect()
    check_pii(list(enumerate(texts)), got)
    by = [g["spans"] for g in got]
    assert by[15] == "iban:5:27" and by[16] == "iban:0:27" and by[17] == ""
    assert by[18] == "ssn:10:21" and by[19] == ""
    spans = {r["doc_id"]: r["spans"] for r in pii.scan(d).collect()}
    assert spans[11][0]["match"] == "+1 (212) 555-1234" and spans[14][0]["start"] == 2
    assert pii.summary(d.limit(0)).collect() == []


def test_pii_of_a_long_list_is_linear(spark):
    texts = {"mail": "a%d@example.org ", "phone": "+49 30 1234%05d; ", "card": "4111 1111 1111 1111, ", "ip": "10.0.0.1 "}
    rows = [(k, "".join(t % i if "%" in t else t for i in range(20_000)), None, None) for k, t in enumerate(texts.values())]
    began = time.time()
    got = pii.summary(docs_frame(spark, rows)).orderBy("doc_id").collect()
    assert time.time() - began < 90                                    # quadratic sums took minutes for 8,000
    check_pii([r[:2] for r in rows], got)


def test_pii_context_words_are_whole_words(spark):
    texts = ["the ship 10.0.0.1 sails", "the ip 10.0.0.1 is", "hosts: 10.0.0.1", "version 10.0.0.1", "hotel +49 30 123456",
             "tel +49 30 123456", "order +49 30 123456", "my social security: 078-05-1120", "part 078-05-1120 social", "antisocial 078-05-1120"]
    got = {r["doc_id"]: [(s["kind"], s["score"]) for s in r["spans"]] for r in pii.scan(docs_frame(spark, [(k, t, None, None) for k, t in enumerate(texts)])).collect()}
    assert [got[k] for k in range(len(texts))] == [
        [("ip", 0.7)], [("ip", 0.9)], [("ip", 0.9)], [("ip", 0.5)], [("phone", 0.6)], [("phone", 0.8)], [("phone", 0.4)],
        [("ssn", 0.6)], [], []]


def next_texts(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]


def tree(text):
    """Sections of paragraphs of leaves, by the definition in merkle's docstring."""
    def cut(pattern, x):
        return [m[0] for m in re.finditer(pattern, x)]
    return [[cut(merkle.LEAF, p) for p in cut(merkle.PARAGRAPH, s)] for s in cut(merkle.SECTION, text)]


def dice(a, b, equal):
    x, y = ({leaf for s in t for p in s for leaf in p} for t in (a, b))
    return 1.0 if equal else min(2 * len(x & y) / (len(x) + len(y)), 0.999999) if x or y else 0.0


def changed(a, b):
    """(section, paragraph, leaf, offset, length) of leaves of ``a`` in branches that ``b`` lacks."""
    out, at = [], 0
    pb = [p for s in b if s not in a for p in s]
    pa = [p for s in a if s not in b for p in s]
    lb = {leaf for p in pb if p not in pa for leaf in p}
    for i, s in enumerate(a):
        for j, p in enumerate(s):
            for k, leaf in enumerate(p):
                if s not in b and p not in pb and leaf not in lb:
                    out.append((i, j, k, at, len(leaf)))
                at += len(leaf)
    return out


def test_merkle_insertion_is_reported_alone(spark):
    old = "\n\n".join(f"Section {i} has one sentence. And it has a second one.\nThen a line of its own." for i in range(40))
    new = old.replace("Section 20 has one sentence. ", "Section 20 has one sentence. Here stands a new remark. ")
    df = spark.createDataFrame([(old, new)], "old string, new string")
    found = df.select(merkle.differing(merkle.tree(F.col("new")), merkle.tree(F.col("old")))).first()[0]
    assert [new[x["at"]:x["at"] + x["n"]] for x in found] == ["Here stands a new remark. "]
    assert df.select(merkle.differing(merkle.tree(F.col("old")), merkle.tree(F.col("new")))).first()[0] == []


@pytest.mark.parametrize("kind", ["hashed", "far", "nulls", "extremes", "copies"])
def test_merkle_neighbours_of_any_ids(spark, kind):
    r = random.Random(4)
    if kind == "hashed":
        ids = list({r.randrange(-2 ** 63, 2 ** 63) for _ in range(3000)})
    elif kind == "far":
        ids = [*range(20_000), 2 ** 60]
    elif kind == "nulls":
        ids = [None] * 12_000 + list(range(2000))
    elif kind == "extremes":
        ids = [-2 ** 63, 0, 2 ** 63 - 1]
    else:
        ids = [5] * 12_000 + [1, 9]
    rows = [(i, "same copy" if kind == "copies" else f"text {k}") for k, i in enumerate(ids)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((x["doc_id"], x["text"], x["next_text"]) for x in merkle.with_next(d).collect())
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    if kind in ("hashed", "far", "extremes", "copies"):
        assert got == Counter((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    else:
        dense = [x for x in order if x[0] is not None]
        pairs = {(i, t): n for (i, t, n) in got}
        assert sum(got.values()) == len(rows) and all(pairs[x] == y[1] for x, y in zip(dense, dense[1:]))
        assert sorted(n for (_, _, n) in got.elements()) == sorted(t for _, t in rows)        # one round through all


def test_merkle_edits(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in E.queries()["op3_merkle"](spark, sf).collect()}
    assert len(got) == len(rows)
    prints = {}
    for i, text, nxt in next_texts(rows):
        g, k = got[i], len(text) // 3
        edited = text[:len(text) - k] + nxt[:k]
        assert g["n_chars"] == len(text)
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (g["fingerprint"] == g["edited_fingerprint"]) == (edited == text)
        assert prints.setdefault(text, g["fingerprint"]) == g["fingerprint"]
        assert (g["near_next"] == 1.0) == (nxt == text)
        a, b, c = tree(text), tree(edited), tree(nxt)
        assert abs(g["near_edited"] - dice(a, b, edited == text)) < 1e-9 and abs(g["near_next"] - dice(a, c, nxt == text)) < 1e-9
        want = changed(a, b)
        assert [tuple(x) for x in g["edits"]] == want and g["edit_at"] == (want[0][3] if want else None)
    assert len(set(prints.values())) == len(prints)


def test_merkle_edge_cases(spark):
    texts = [None, "", "one", "one", " lead. and trail. \n\n\n", "\n", "x" * 100_000, "word " * 20_000, "A. B! C?\nD.\n" * 3000, "\U0001f600é" * 50]
    d = docs_frame(spark, [(k, t, None, None) for k, t in enumerate(texts)] + [(None, "none", None, None), (3, "three", None, None)],
                   extra=("fingerprint", "bucket"))
    got = merkle.compare_edits(d).collect()
    assert len(got) == len(texts) + 2
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "none"), (3, "three")]
    want = sorted(((-1 if i is None else i), hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest())
                  for i, t, n in next_texts(rows))
    assert sorted(((-1 if g["doc_id"] is None else g["doc_id"]), g["edited_sha256"]) for g in got) == want
    prints = merkle.fingerprints(d).collect()
    by = {}
    for r in prints:
        assert by.setdefault(r["text"] or "", r["fingerprint"]) == r["fingerprint"]
    assert len(set(by.values())) == len(by)
    pieces = spark.createDataFrame([(t,) for t in texts if t], "text string").selectExpr(
        "text", f"array_join(regexp_extract_all(text, r'{merkle.SECTION}', 0), '') as a", f"array_join(regexp_extract_all(text, r'{merkle.LEAF}', 0), '') as b")
    for r in pieces.collect():
        assert r["a"] == r["text"] and r["b"] == r["text"]
    assert merkle.compare_edits(d.limit(0)).collect() == []
    one = merkle.compare_edits(docs_frame(spark, [(7, "only one here", None, None)])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"only one only").hexdigest()


def test_bpe_vocabulary_without_a_byte_raises():
    codec = bpe.Codec([b"a", b"b", b"ab", b"\xc3\xa9"], [0, 1, 2, 3], r"\S+")
    assert codec.encode("ab abab ba é") == [2, 2, 2, 1, 0, 3]
    assert codec.merge(b"\xc3\xa9a") == (3, 0)                 # bytes that always merge need no token of their own
    with pytest.raises(KeyError):
        codec.encode("abc")
