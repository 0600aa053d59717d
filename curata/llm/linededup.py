"""Near-duplicate lines over the whole corpus by an exact set-similarity join.

DataFrame functions only.  A line is the set of its words.  Words are ordered
by rarity, from a table of word counts by hash bucket: any order that all
lines share keeps the prefix filter exact, and rare words in front keep it
selective.  Two lines with Jaccard >= t share a word among the first
n - ceil(t*n) + 1, their lengths differ by at most the factor t, the position
of the first shared word bounds their overlap, and the parity of 128 hashed
bits bounds their difference.  What passes is verified on the word sets.

Equal lines form one class, represented by its earliest line.  Families of
similar lines are thinned first: every class is checked against the earliest
class under each of its rarest words, and only pairs with a class that this
leaves without an earlier match come out of the full join.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL, fresh, ident, joined, let, packed, written

BLANKS = "\t\x0b\x0c\r"          # white space within a line beside the space
BUCKETS = 1 << 17                # word counts are kept by hash bucket; a bounded table
LEADS = 5                        # rarest words under which a class meets its family's earliest line
FIELD = (1 << 15) - 1            # word counts and positions are kept up to here; at it, no filter applies
LAST = (1 << 63) - 1


def _spaced(text: Column) -> Column:
    """The text with every blank a space (rarely any work), so that its lines split and trim at spaces alone."""
    odd = F.lit(False)
    for c in BLANKS:
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, F.translate(text, BLANKS, " " * len(BLANKS))).otherwise(text)


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1).cast("long"))


def rarity(docs: DataFrame) -> list[int]:
    """For each hash bucket of words how often its words occur, on a logarithmic scale (1 to 62)."""
    words = docs.select(F.explode(F.split(F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.where("w <> ''").groupBy(_bucket(F.xxhash64("w")).alias("b")).count().collect()   # at most BUCKETS rows
    out = [1] * BUCKETS
    for b, n in counts:
        out[b] = min(62, 1 + int(1.5 * math.log2(n)))
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, mark, no, line): every line with a word, trimmed."""
    d = docs.select("doc", "mark", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("no", "line"))
    return d.withColumn("line", F.trim("line")).where("line <> ''")


def _words(line: Column) -> Column:
    hashes = F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def _ordered(words: Column, levels: list[int]) -> Column:
    """Word hashes as longs that sort by rarity: level in the high byte, hash below."""
    table = F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")     # folded to a constant; small numbers stay in the CPU's cache

    def key(h: Column) -> Column:                                                    # never null: primitive sort
        level = F.coalesce(F.get(table, _bucket(h).cast("int")), F.lit(1).cast("long"))
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    return F.sort_array(F.transform(words, key))


def _middle(levels: list[int]) -> int:
    """The least key of the common words: about half of all words in the texts are rarer."""
    uses = {level: n * (2 ** ((level - 1) / 1.5) - 1) for level, n in Counter(levels).items()}     # empty buckets weigh nothing
    at, rest = 0, sum(uses.values()) / 2
    while rest > 0:
        at += 1
        rest -= uses.get(at, 0)
    return (at + 1) << 56


def _parity(keys: Column) -> Column:
    """64 parity bits: every word flips one."""
    one = F.lit(1).cast("long")
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(
        F.call_function("shiftleft", one, k.bitwiseAND(F.lit(63).cast("long")).cast("int"))))


def _sub(no: Column, mark: Column) -> Column:
    """A line's place within the rows of one doc_id: line number, then half of the row's hash."""
    return F.shiftleft(no.cast("long"), 32).bitwiseOR(mark.bitwiseAND(F.lit((1 << 32) - 1)))


def _classes(docs: DataFrame, levels: list[int], t: float) -> DataFrame:
    """One row per different line: h, h2 (its hash), doc, sub, mark, no (the earliest), n, parity (of its
    rare words), parity2 (of the common ones), prefix, copies."""
    d = _lines(docs).select(
        F.xxhash64("line").alias("h"), F.hash("line").alias("h2"), "doc", "mark", "no",
        _ordered(_words(F.col("line")), levels).alias("keys"))
    cut = F.lit(_middle(levels)).cast("long")
    d = d.withColumn("common", F.array_position(F.sort_array(F.concat("keys", F.array(cut))), cut).cast("int"))    # where the common words start
    n = F.size("keys")
    long = (n - F.ceil(n * t - 1e-9) + 1).cast("int")
    d = d.select("h", "h2", F.struct(
        F.coalesce("doc", F.lit(LAST)).alias("doc"), _sub(F.col("no"), F.col("mark")).alias("sub"), "mark", "no", n.alias("n"),
        _parity(F.slice("keys", F.lit(1), F.col("common") - 1)).alias("parity"), _parity(F.slice("keys", F.col("common"), n)).alias("parity2"),
        F.slice("keys", F.lit(1), long).alias("prefix")).alias("first"))
    return d.groupBy("h", "h2").agg(F.min("first").alias("first"), F.count("*").alias("copies")).select("h", "h2", "first.*", "copies")


def _packed_size(n: Column, at: Column, done: Column) -> Column:
    """Word count, position from 1 and a flag in one number: what travels with a prefix word."""
    return (F.least(n, F.lit(FIELD)) * (FIELD + 1) + F.least(at + 1, F.lit(FIELD))) * 2 + done


def _opened(size: Column) -> tuple[Column, Column]:
    return F.shiftright(size, 16), F.shiftright(size, 1).bitwiseAND(F.lit(FIELD))


def _may_match(x: str, y: str, t: float) -> Column:
    """The length, positional and parity filters for entries x and y of one word."""
    (nx, ax), (ny, ay) = (_opened(F.col(f"{side}.size")) for side in (x, y))
    differ = sum(F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in ("parity", "parity2"))
    settled = F.col(f"{y}.size").bitwiseAND(F.lit(1)) * (2 * FIELD)      # a flagged y has its match: nothing fits it any more
    least = F.ceil((nx + ny) * (t / (1 + t)) - 1e-9)
    fits = ((F.least(nx, ny) >= F.greatest(nx, ny) * t - 1e-9)
            & (F.least(nx - ax, ny - ay) + 1 >= least)
            & (differ + settled <= nx + ny - 2 * least))
    return (F.greatest(nx, ny) >= FIELD) | fits


def _earlier(x: str, y: str) -> Column:
    return (F.col(f"{x}.doc") < F.col(f"{y}.doc")) | ((F.col(f"{x}.doc") == F.col(f"{y}.doc")) & (F.col(f"{x}.sub") < F.col(f"{y}.sub")))


def _verified(docs: DataFrame, classes: DataFrame, both: DataFrame, t: float) -> tuple[DataFrame, int]:
    """(h, h2) of the classes y among the pairs x, y whose word sets have Jaccard >= t, and their number."""
    pairs = written(both.select(F.col("x.doc").alias("xd"), F.col("x.sub").alias("xs"), F.col("y.doc").alias("yd"), F.col("y.sub").alias("ys"))
                    .distinct(), "line-pairs")
    rows = pairs.count()
    ends = pairs.select(F.col("xd").alias("doc"), F.col("xs").alias("sub")).union(pairs.select("yd", "ys")).distinct()
    at = joined(classes.select("doc", "sub", "h", "h2", "mark", "no"), ends, 2 * rows, ["doc", "sub"], "left_semi")
    at = written(packed(at, 2 * rows), "line-ends")
    # the needed lines of a text by number, so that its other lines are left alone
    need = written(at.groupBy("mark").agg(F.collect_list(F.struct("no", "doc", "sub", "h", "h2")).alias("need")), "line-needs")
    texts = joined(docs.select("mark", "text"), need, need.count() * 2, "mark")
    texts = texts.select(F.explode(let(F.split(_spaced(F.col("text")), "\n"), lambda lines: F.transform("need", lambda e: F.struct(
        e["doc"].alias("doc"), e["sub"].alias("sub"), e["h"].alias("h"), e["h2"].alias("h2"), F.trim(F.get(lines, e["no"])).alias("line"))))).alias("e"))
    sets = written(texts.select("e.doc", "e.sub", "e.h", "e.h2", _words(F.col("e.line")).alias("words")), "line-words")
    small = rows <= SMALL // 20                                     # word sets are some 20 times as wide
    x = sets.select(F.col("doc").alias("xd"), F.col("sub").alias("xs"), F.col("words").alias("xwords"))
    y = sets.select(F.col("doc").alias("yd"), F.col("sub").alias("ys"), "h", "h2", F.col("words").alias("ywords"))
    p = pairs.join(F.broadcast(x) if small else x, ["xd", "xs"]).join(F.broadcast(y) if small else y, ["yd", "ys"])
    common = F.size(F.array_intersect("xwords", "ywords"))
    good = common / (F.size("xwords") + F.size("ywords") - common) >= t
    out = written(packed(p.where(good).select("h", "h2").distinct(), rows), "line-matched")
    return out, out.count()


def matches(docs: DataFrame, t: float = 0.8) -> tuple[DataFrame, DataFrame, int]:
    """For rows (doc, mark, text): the classes of lines, (h, h2) of those that
    match an earlier line, and their number.  Words are case-sensitive."""
    classes = written(_classes(docs, rarity(docs), t), "line-classes")
    line = ["doc", "sub", "parity", "parity2"]

    def entries(c: DataFrame, prefix: Column, done: Column) -> DataFrame:
        e = c.select(*line, "n", done.alias("done"), F.posexplode(prefix).alias("at", "key"))
        return e.select("key", *line, _packed_size(F.col("n"), F.col("at"), F.col("done")).alias("size"))

    rare = entries(classes, F.slice("prefix", 1, LEADS), F.lit(0))
    lead = rare.groupBy("key").agg(F.min(F.struct(*line, "size")).alias("x"), F.count("*").alias("lines"))
    lead = lead.where("lines > 1").select("key", "x.*").alias("x")
    first = lead.join(rare.alias("y"), (F.col("x.key") == F.col("y.key")) & _earlier("x", "y") & _may_match("x", "y", t))
    done, found = _verified(docs, classes, first, t)

    state = joined(classes, done.withColumn("done", F.lit(1)), found, ["h", "h2"], "left")
    full = entries(state, F.col("prefix"), F.coalesce("done", F.lit(0)))         # both sides alike: one exchange
    rest = full.alias("x").join(full.alias("y"), (F.col("x.key") == F.col("y.key")) & _earlier("x", "y") & _may_match("x", "y", t))
    more, also = _verified(docs, classes, rest, t)
    return classes, written(packed(done.union(more).distinct(), found + also), "line-matched"), found + also


def dedup(docs: DataFrame, t: float = 0.8, doc_id: str = "doc_id", text: str = "text",
          n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """``docs`` with every line removed that matches an earlier one, plus the
    number of lines with a word and of those removed.

    Earlier is by doc_id (nulls last), then line number, then a hash of id and
    text; a line goes if any earlier line has Jaccard >= ``t`` with it,
    removed or not.  Of rows with equal id and text one keeps its lines.
    Blank lines stay; a null text stays null with no lines.  Columns keep
    their order; extra columns pass through, columns named like the two
    counts are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in (n_lines.lower(), n_removed.lower())]
    mark, copy, gone, lines = fresh([*docs.columns, n_lines, n_removed], "mark", "copy", "gone", "lines")
    key = F.xxhash64(ident(doc_id), F.lit("|"), ident(text))
    d = docs.select(ident(doc_id).cast("long").alias("doc"), key.alias("mark"), ident(text).alias("text")).where(F.col("text").isNotNull())
    again = written(d.groupBy("mark").count().where("count > 1").select("mark"), "line-repeated")
    repeats = again.count()
    if repeats:                                                  # of equal rows one takes part
        d = joined(d, again, repeats, "mark", "left_anti").union(
            joined(d, again, repeats, "mark", "left_semi").dropDuplicates(["mark"]))
    again = again.withColumnRenamed("mark", mark)
    classes, matched, found = matches(d, t)
    state = joined(classes.select("h", "h2", F.col("mark").alias("m0"), F.col("no").alias("no0"), "copies"),
                   matched.withColumn("hit", F.lit(True)), found, ["h", "h2"], "left")
    state = written(state.where("hit OR copies > 1").drop("copies"), "line-state")       # lines of the other classes all stay
    seen = _lines(d).select("mark", "no", F.xxhash64("line").alias("h"), F.hash("line").alias("h2"))
    out = joined(seen, state, state.count(), ["h", "h2"]).where("hit OR mark <> m0 OR no <> no0")
    out = written(out.groupBy("mark").agg(F.collect_set("no").alias("gone")), "line-removed")     # lists within one text
    out = out.select(F.col("mark").alias(mark), F.col("gone").alias(gone))

    full = docs.select(*(ident(c) for c in kept)).withColumn(mark, key)
    once = joined(full, again, repeats, mark, "left_anti").withColumn(copy, F.lit(1))
    if repeats:                                                  # the others lose every line
        nth = F.row_number().over(Window.partitionBy(mark).orderBy(ident(doc_id)))
        once = once.union(joined(full, again, repeats, mark, "left_semi").withColumn(copy, nth))
    full = joined(once, out, out.count(), mark, "left").withColumn(lines, F.split(_spaced(ident(text)), "\n"))
    worded = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i)) != "")
    none = F.array().cast("array<int>")
    full = full.withColumn(gone, F.when(ident(text).isNull(), none).when(F.col(copy) > 1, worded).otherwise(F.coalesce(gone, none)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = let(F.split(ident(text), "\n"), lambda own: F.array_join(F.transform(stay, lambda i: F.get(own, i)), "\n"))
    shown = F.when(F.size(gone) == 0, ident(text)).otherwise(rest)
    count = F.when(ident(text).isNull(), F.lit(0)).otherwise(F.size(worded))
    return full.select(*(shown.alias(c) if c == text else ident(c) for c in kept),
                       count.cast("long").alias(n_lines), F.size(gone).cast("long").alias(n_removed))


def keep_new(docs: DataFrame, t: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`dedup` in the columns of ``docs``, without the documents that lost every line."""
    a, b = fresh(docs.columns, "n_lines", "n_removed")
    d = dedup(docs, t, doc_id, text, a, b)
    return d.where((F.col(a) == 0) | (F.col(b) < F.col(a))).select(*(ident(c) for c in docs.columns))
