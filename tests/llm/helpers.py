"""Brute-force versions of the training-data operators, in plain Python."""

import itertools
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def ascii_words(text):
    return WORD.findall(bytes((text or "").encode("utf-8")).lower())


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def docs_frame(spark, rows, extra=()):
    """Documents with clashing extra columns: rows of (doc_id, text, lang, source)."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
    schema += "".join(f", `{name}` string" for name in extra)
    return spark.createDataFrame([r + tuple("x" for _ in extra) for r in data], schema)


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in itertools.combinations(list(nodes), 2):
        if linked(a, b):
            parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def later_lines(rows, t):
    """(row number, line number) of every line that matches an earlier one;
    rows: (doc_id, text) in order."""
    seen, gone = [], set()
    for r, (_, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = set(re.findall(r"[^\x20\x09-\x0D]+", line))
            if not words:
                continue
            if any(len(words & w) / len(words | w) >= t for w in seen):
                gone.add((r, k))
            seen.append(words)
    return gone


def mix_by_hand(rows, weights, cap, block, order_key, golden):
    """rows: (source, size, key); returns {source: (target, {key: words taken})}."""
    sources = sorted({s for s, _, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for x, n, _ in rows if x == s) for s in sources}
    total = sum(size.values())
    w = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    stopped = set()
    while total:
        rest = sum(w[s] for s in sources if s not in stopped)
        share = (total - sum(cap * size[s] for s in stopped)) / rest
        above = {s for s in sources if share * w[s] > cap * size[s]}
        if above == stopped:
            break
        stopped = above
    target = {s: float(min(share * w[s], cap * size[s])) if total else 0.0 for s in sources}
    full = math.fsum(target.values())
    slots = {s: 0 for s in sources}
    bounds, at = [], 0.0
    for s in sources:
        at += target[s]
        bounds.append((at / full if full else 0, s))
    last = [s for s in sources if target[s] > 0][-1:] or [None]
    for k in range(-(-total // block)):
        u = golden(k)
        slots[next((s for b, s in bounds if u < b), last[0])] += 1
    out = {}
    for s in sources:
        taken, left = {}, min(slots[s] * block, cap * size[s])
        own = sorted(((key, n) for x, n, key in rows if x == s and n), key=lambda r: order_key(r[0]))
        while left > 0 and own:
            for key, n in own:
                got = min(n, left)
                taken[key] = taken.get(key, 0) + got
                left -= got
                if not left:
                    break
        out[s] = (target[s], taken)
    return out
