"""Licence scan: TF-IDF cosine of headers and licence files to templates, then
inheritance from the nearest ancestor directory.

Every line of a text, and every paragraph of several lines, is compared with
every template.  Term weights come from how many lines of the whole corpus
hold a word, counted for every word.  Templates and a bounded number of common
words are broadcast with their weights; those bound the weights of the rare
words, so that only few lines are left as candidates for a text's best cosine.
The rare words of these are joined to their counts.  A licence file (by its name) covers its directory: paths are
joined on ancestor directories, once per directory and not per file.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, ident, python_ready, written

# Names by SPDX identifier, texts as licences ask them to be cited
# (the short ones also as authors commonly abbreviate them).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {name}{form}") for name, forms in (
        *((x, ("",)) for x in ("MIT", "Apache-2.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
                               "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CC0-1.0", "Unlicense")),
        *((x, ("", "-only", "-or-later")) for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"))) for form in forms),
)
SPDX = "SPDX-License-Identifier: "   # such templates match only where all words of the identifier stand
LONGER = {"BSD-2-Clause": "BSD-3-Clause"}        # same opening line; the second where the text has its own clause too
COMMON = 50_000                  # words broadcast with their counts, the most frequent ones
HELD = 200_000                   # words counted in a task before they are passed on
_RARE = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("square", T.LongType())]))
UNITS = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("base", T.DoubleType()), T.StructField("ks", T.ArrayType(T.IntegerType())),
                                  T.StructField("dots", T.ArrayType(T.DoubleType())), T.StructField("rare", _RARE)]))
UNITS_ARROW = pa.list_(pa.struct([("line", pa.int32()), ("block", pa.int32()), ("base", pa.float64()), ("ks", pa.list_(pa.int32())),
                                  ("dots", pa.list_(pa.float64())), ("rare", pa.list_(pa.struct([("word", pa.binary()), ("square", pa.int64())])))]))
FOUND = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("line", T.LongType())]))
FOUND_ARROW = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("line", pa.int64())]))
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|copyright)([.-].*)?$"
_KEPT = bytes(c if chr(c).isalnum() or c >= 128 or c == 10 else 32 for c in range(256))


def words_of(text: str) -> list[list[bytes]]:
    """Words of every line: ASCII lower case, cut at ASCII punctuation and white space."""
    return [x.split() for x in text.encode("utf-8").lower().translate(_KEPT).split(b"\n")]


class Matcher:
    """Templates as weighted vectors over their own words.

    ``counts`` holds the lines of every template word and every common word;
    all other words are rare: at least one and at most ``most`` lines each.
    """

    def __init__(self, templates, counts: dict[bytes, int], lines: int, most: int):
        self.names = [name for name, _ in templates]
        bags = [sum(words_of(text), []) for _, text in templates]
        own = sorted({w for bag in bags for w in bag})
        self.own, self.lines = len(own), lines
        self.ids = {w: i for i, w in enumerate([*own, *sorted(counts.keys() - set(own))])}
        self.idf = np.array([self.weight(counts.get(w, 0)) for w in self.ids])
        self.bounds = self.weight(most) ** 2, self.weight(1) ** 2       # of a rare word
        m = np.zeros((len(bags), len(own)))
        for k, bag in enumerate(bags):
            for w in bag:
                m[k, self.ids[w]] += 1
        m *= self.idf[:self.own]
        marked = [(k, text[len(SPDX):]) for k, (_, text) in enumerate(templates) if text.startswith(SPDX)]
        self.needs = {k: {self.ids[w] for w in (b"spdx", *sum(words_of(x), []))} for k, x in marked}
        self.marked = list(self.needs)
        self.weights = (m / np.linalg.norm(m, axis=1, keepdims=True)).T.copy()      # words x templates

    def weight(self, df: int) -> float:
        return float(np.log((1 + self.lines) / (1 + df)) + 1)

    def candidates(self, text: str, threshold: float) -> list[dict]:
        """The lines and paragraphs that may hold the best cosine or one at
        the threshold, whatever the weights of their rare words are within
        their bounds: dot products, squared norm without rare words, and
        those words with their squared counts."""
        rows = words_of(text)
        flat = [w for row in rows for w in row]
        known, total, other = self.ids, len(self.ids), {}
        word = np.array([known[w] if w in known else total + other.setdefault(w, len(other)) for w in flat], np.int64)
        if not (word < self.own).any():
            return []
        line = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
        blank = np.array([not row for row in rows])
        block = np.cumsum(blank)
        several = (np.bincount(block[~blank], minlength=block[-1] + 1) > 1)[block[line]]    # one line is a paragraph as it is
        unit = np.concatenate([line, len(rows) + block[line][several]])
        word = np.concatenate([word, word[several]])
        size = total + len(other)
        pair, tf = np.unique(unit * size + word, return_counts=True)
        at, w = pair // size, pair % size
        rare = w >= total
        squares = tf.astype(np.float64) ** 2
        units = len(rows) + int(block[-1]) + 1
        base = np.bincount(at[~rare], squares[~rare] * self.idf[w[~rare]] ** 2, minlength=units)
        rest = np.bincount(at[rare], squares[rare], minlength=units)
        held = w < self.own
        first = np.flatnonzero(np.diff(at[held], prepend=-1))
        dots = np.add.reduceat((tf[held] * self.idf[w[held]])[:, None] * self.weights[w[held]], first, axis=0)
        some = at[held][first]
        if self.marked:
            tags = np.isin(some, at[w == self.ids[b"spdx"]])
            dots[np.ix_(~tags, self.marked)] = 0.0
            for k, need in self.needs.items() if tags.any() else ():
                dots[~np.logical_and.reduce([np.isin(some, at[w == x]) for x in need]), k] = 0.0
        least, most = (dots / np.sqrt(base[some] + rest[some] * x)[:, None] for x in self.bounds[::-1])
        fits = most >= min(least.max(), threshold) - 1e-9
        out, words = [], list(other)
        for i in np.flatnonzero(fits.any(axis=1)):
            u = int(some[i])
            lo, hi = np.searchsorted(at, (u, u + 1))
            ks = np.flatnonzero(fits[i])
            start = u if u < len(rows) else int(np.flatnonzero((block == u - len(rows)) & ~blank)[0])
            out.append({"line": start + 1, "block": int(block[start]) if u < len(rows) else -1 - u + len(rows), "base": float(base[u]), "ks": ks.tolist(), "dots": dots[i, ks].tolist(),
                        "rare": [{"word": words[w[j] - total], "square": int(squares[j])} for j in range(lo, hi) if rare[j]]})
        return out

    def best(self, candidates: list[dict], rare: list[dict], threshold: float) -> tuple[str | None, float, int | None, list[dict]]:
        """(name, cosine, line number from 1) of the best template: of equal
        cosines the earlier template, then the earlier line; and all licences
        declared, best first.  ``rare`` has the squared count and the lines of
        each rare word by candidate.

        A paragraph or line declares its best template at the threshold, a
        line only if it is no worse than its paragraph; an SPDX line declares
        every identifier that it holds and that is no part of a longer one.
        """
        rest = [[] for _ in candidates]
        for x in rare:
            rest[x["at"]].append(x["square"] * self.weight(x["n"]) ** 2)
        units = []
        for c, more in zip(candidates, rest):
            norm = math.sqrt(c["base"] + math.fsum(more))
            units.append(sorted((-round(dot / norm, 12), k, c["line"]) for k, dot in zip(c["ks"], c["dots"])))
        if not units:
            return None, 0.0, None, []
        got = min(u[0] for u in units)
        score = -round(got[0], 9)
        if score < threshold:
            return None, score, None, []
        whole = {-1 - c["block"]: u[0][0] for c, u in zip(candidates, units) if c["block"] < 0}
        said = {got}
        for c, unit in zip(candidates, units):
            full = [x for x in unit if -round(x[0], 9) >= threshold]
            if full and full[0][0] <= whole.get(c["block"], 0.0):
                tags = [x for x in full if x[1] in self.needs] if full[0][1] in self.needs else []
                said |= {full[0], *(x for x in tags if not any(self.needs[x[1]] < self.needs[y[1]] for y in tags))}
        names = {self.names[k] for _, k, _ in said}
        found = {}
        for minus, k, line in sorted(said):
            name = LONGER[self.names[k]] if LONGER.get(self.names[k]) in names else self.names[k]
            found.setdefault(name, {"license": name, "score": -round(minus, 9), "line": line})
        return next(iter(found)), score, got[2], list(found.values())


def _counted(texts: DataFrame) -> DataFrame:
    """(word, n): how many lines hold each word of the corpus; under the empty
    word the number of lines with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

        n = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for row in words_of(text):
                    if row:
                        n.update({b"", *row})
            if len(n) > HELD:
                yield out()
                n.clear()
        yield out()

    return written(texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "licence-words")


def declared(files: DataFrame, text: str = "text", templates=TEMPLATES, threshold: float = 0.6,
             names=("license", "score", "license_line", "licenses"), common: int = COMMON, drop: bool = False) -> DataFrame:
    """All columns of ``files`` (with ``drop`` without the text) plus the
    licence that a text declares itself (null below ``threshold``), the best
    cosine, the line where it starts, and all licences declared (license,
    score, line; the best first)."""
    spark = files.sparkSession
    python_ready(spark)
    vocabulary = sorted({w for _, t in templates for row in words_of(t) for w in row})
    clean = F.coalesce(ident(text), F.lit(""))
    words = _counted(files.select(clean.alias("text")))
    bits, least = F.length(F.bin("n")), 1
    left = common
    for r in words.groupBy(bits.alias("bits")).count().orderBy(F.desc("bits")).collect():          # 63 rows at most
        left -= r["count"]
        if left < 0:
            least = 1 << r["bits"]
            break
    held = words.where((F.col("n") >= least) | F.col("word").isin([b"", *vocabulary])).collect()   # ``common`` words and the templates'
    counts = {bytes(r["word"]): r["n"] for r in held}
    lines = counts.pop(b"", 0)
    matcher = spark.sparkContext.broadcast(Matcher(templates, counts, lines, max(1, least - 1)))
    low = [n.lower() for n in names]
    gone = [*low, text.lower()] if drop else low
    kept = [c for c in files.columns if c.lower() not in gone]
    tmp, key, units, rare = fresh([*files.columns, *names], "text_in", "row_key", "units", "rare")
    fields = [f for f in files.schema.fields if f.name in kept]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matcher.value
        for batch in batches:
            got = [m.candidates(x, threshold) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, UNITS_ARROW)], names=[*batch.schema.names[:-1], units])

    seen = files.select(*(ident(c) for c in kept), clean.alias(tmp)).mapInArrow(look, T.StructType([*fields, T.StructField(units, UNITS)]))
    seen = written(seen.withColumn(key, F.monotonically_increasing_id()), "licence-units")          # the key is fixed by writing
    pairs = seen.select(F.col(key).alias("key"), F.posexplode(units).alias("at", "unit")).select("key", "at", F.explode("unit.rare").alias("x"))
    pairs = pairs.select("key", "at", F.col("x.word").alias("word"), F.col("x.square").alias("square"))
    weighed = pairs.join(words, "word").groupBy("key").agg(F.collect_list(F.struct("at", "square", "n")).alias(rare))
    rest = F.transform(units, lambda u: u.dropFields("rare")).alias(units)
    d = seen.select(*(ident(c) for c in kept), rest, F.col(key)).join(weighed.withColumnRenamed("key", key), key, "left")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matcher.value
        for batch in batches:
            got = [m.best(u or [], r or [], threshold) for u, r in zip(*(c.to_pylist() for c in batch.columns[-2:]))]
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.int64(), FOUND_ARROW))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *cols], names=[*batch.schema.names[:-2], *names])

    kinds = (T.StringType(), T.DoubleType(), T.LongType(), FOUND)
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in zip(names, kinds))])
    return d.select(*(ident(c) for c in kept), units, rare).mapInArrow(settle, schema)


def scan(files: DataFrame, file_id: str = "doc_id", path: str = "path", text: str = "text", templates=TEMPLATES,
         threshold: float = 0.6, common: int = COMMON) -> DataFrame:
    """One row per row of ``files``: file_id, path, license (declared), score,
    license_line, inherited, inherited_from (a directory), effective, licenses
    (all declared, with score and line), inherited_licenses (names).

    ``inherited`` is the licence of the nearest directory at or above the
    file's that has a licence file declaring one (of several the highest
    cosine, then the smallest path); ``inherited_licenses`` are all that this
    directory's licence files declare.  Own declarations go first in
    ``effective``.  A null path inherits nothing; a null text declares nothing.
    """
    d = files.select(ident(file_id).alias("file_id"), ident(path).alias("path"), ident(text).alias("text"))
    d = written(declared(d, "text", templates, threshold, common=common, drop=True), "licences")        # read three times below
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
    d = d.withColumn("folder", F.when(F.col("path").isNotNull(), folder))
    named = d.where(F.element_at(parts, -1).rlike(LICENCE_FILE) & F.col("license").isNotNull())
    named = named.withColumn("one", F.explode("licenses.license"))
    covers = named.groupBy("folder").agg(F.min_by("license", F.struct(-F.col("score"), "path", "license")).alias("inherited"),
                                         F.sort_array(F.collect_set("one")).alias("every"))
    folders = d.where("folder IS NOT NULL").select("folder").distinct()
    steps = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))).alias("up")).distinct()
    near = above.join(covers.withColumnRenamed("folder", "up"), "up").groupBy("folder").agg(
        F.max(F.struct(F.length("up").alias("n"), "up", "inherited", "every")).alias("best"))
    near = near.select("folder", F.col("best.inherited").alias("inherited"), F.col("best.up").alias("inherited_from"),
                       F.col("best.every").alias("inherited_licenses"))
    d = d.join(near, "folder", "left")
    return d.select("file_id", "path", "license", "score", "license_line", "inherited", "inherited_from",
                    F.coalesce("license", "inherited").alias("effective"), "licenses", "inherited_licenses")
