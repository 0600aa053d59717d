"""Document fingerprints: a Merkle tree over sections, paragraphs and leaves.

DataFrame functions only.  A section is a run of lines up to a blank line (or
eight lines), a paragraph a line with its line ends, a leaf up to six words of
one sentence.  The pieces tile the text, so the root stands for every code
point: equal roots, equal texts.  Where roots differ, equal branches are
skipped and the differing leaves locate the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ident, let, starts, written

SECTION = r"(?:[^\n]++\n?+){1,8}+\n*+|\n++"
PARAGRAPH = r"[^\n]++\n*+|\n++"
LEAF = r"(?s)(?=.)(?:[^ \n]*+(?<![.!?]) ++){0,5}+[^ \n]*+[ \n]*+"
ROWS = 512                       # documents of neighbouring ids handled together, about


def _pieces(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _node(mark: str, hashes: Column) -> Column:
    return F.sha2(F.concat(F.lit(mark), F.array_join(hashes, "")), 256)


def tree(text: Column) -> Column:
    """array<struct<hash, paragraphs array<struct<hash, leaves array<struct<hash, n>>>>>>:
    the sections of a text; n is a leaf's number of code points."""
    def leaf(x: Column) -> Column:
        return F.struct(F.sha2(F.concat(F.lit("leaf:"), x), 256).alias("hash"), F.length(x).alias("n"))

    def paragraph(x: Column) -> Column:
        leaves = F.transform(_pieces(x, LEAF), leaf)
        return F.struct(leaves.alias("leaves"))

    def named(p: Column) -> Column:
        return F.struct(_node("paragraph:", F.transform(p["leaves"], lambda x: x["hash"])).alias("hash"), p["leaves"].alias("leaves"))

    def section(x: Column) -> Column:
        return F.transform(F.transform(_pieces(x, PARAGRAPH), paragraph), named)

    def topped(ps: Column) -> Column:
        return F.struct(_node("section:", F.transform(ps, lambda p: p["hash"])).alias("hash"), ps.alias("paragraphs"))

    return F.transform(F.transform(_pieces(text, SECTION), section), topped)


def root(sections: Column) -> Column:
    """The fingerprint: hash over the section hashes."""
    return _node("document:", F.transform(sections, lambda s: s["hash"]))


def leaves(sections: Column) -> Column:
    """array<struct<hash, n>> of all leaves in order."""
    return F.flatten(F.transform(sections, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"]))))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Dice coefficient of two leaf arrays' distinct hashes: 1 if the roots are
    equal (``equal``), below 1 otherwise, 0 without a common leaf."""
    x, y = F.transform(a, lambda v: v["hash"]), F.transform(b, lambda v: v["hash"])
    x, y = F.array_distinct(x), F.array_distinct(y)
    common = F.size(F.array_intersect(x, y))
    dice = F.coalesce(F.try_divide(2.0 * common, F.size(x) + F.size(y)), F.lit(0.0))
    return F.when(equal, 1.0).otherwise(F.least(dice, F.lit(0.999999)))


def differing(a: Column, b: Column) -> Column:
    """array<struct<section, paragraph, leaf, at, n>>: the leaves of tree ``a`` that tree ``b`` has
    not, by their places (from 0) and code-point offsets and lengths in the first text.

    Sections that the other tree has too, wherever they stand, are skipped whole; in the
    others only paragraphs are compared that no differing section of the other tree has, then
    only the leaves of those.  So an insertion is reported alone and does not shift the rest.
    """
    def hashes(x: Column) -> Column:
        return F.transform(x, lambda v: v["hash"])

    def missing(x: Column, known: Column) -> Column:
        return F.filter(x, lambda v: ~F.array_contains(known, v["hash"]))

    def size(ps: Column) -> Column:
        return F.aggregate(ps, F.lit(0).cast("long"), lambda t, p: t + F.aggregate(p["leaves"], F.lit(0).cast("long"), lambda u, x: u + x["n"]))

    def sections(z: Column) -> Column:
        known = F.struct(hashes(z["a"]).alias("a"), hashes(z["b"]).alias("b"),
                         starts(F.transform(z["a"], lambda s: size(s["paragraphs"]))).alias("at"))

        def apart(k: Column) -> Column:
            own = F.transform(z["a"], lambda s, i: F.struct(s["hash"].alias("hash"), i.alias("section"), F.get(k["at"], i).alias("at"),
                                                            s["paragraphs"].alias("paragraphs")))
            other = F.flatten(F.transform(missing(z["b"], k["a"]), lambda s: s["paragraphs"]))
            return F.struct(missing(own, k["b"]).alias("own"), other.alias("other"))
        return let(known, apart)

    def paragraphs(z: Column) -> Column:
        own = F.flatten(F.transform(z["own"], lambda s: F.transform(s["paragraphs"], lambda p, j: F.struct(
            p["hash"].alias("hash"), s["section"].alias("section"), j.alias("paragraph"), p["leaves"].alias("leaves"),
            (s["at"] + size(F.slice(s["paragraphs"], F.lit(1), j))).alias("at")))))         # a section is a few lines

        def apart(k: Column) -> Column:
            known = F.struct(hashes(k["own"]).alias("a"), hashes(z["other"]).alias("b"))
            return let(known, lambda h: F.struct(missing(k["own"], h["b"]).alias("own"),
                                                 F.flatten(F.transform(missing(z["other"], h["a"]), lambda p: hashes(p["leaves"]))).alias("other")))
        return let(F.struct(own.alias("own")), apart)

    def last(z: Column) -> Column:
        def placed(p: Column) -> Column:
            at = starts(F.transform(p["leaves"], lambda x: x["n"].cast("long")))
            return let(at, lambda s: F.transform(p["leaves"], lambda x, i: F.struct(
                x["hash"].alias("hash"), p["section"].alias("section"), p["paragraph"].alias("paragraph"), i.alias("leaf"),
                (p["at"] + F.get(s, i)).alias("at"), x["n"].alias("n"))))
        gone = missing(F.flatten(F.transform(z["own"], placed)), z["other"])
        return F.transform(gone, lambda x: F.struct(x["section"].alias("section"), x["paragraph"].alias("paragraph"), x["leaf"].alias("leaf"),
                                                    x["at"].alias("at"), x["n"].alias("n")))

    return let(let(let(F.struct(a.alias("a"), b.alias("b")), sections), paragraphs), last)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` plus ``out``, the root of ``text`` (null: as the empty text)."""
    return docs.withColumn(out, root(tree(F.coalesce(ident(text), F.lit("")))))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id long, text) plus next_text: the text of the next row in
    descending doc_id (nulls last; repeated ids by the text's first 64 code points, then a
    hash of it), after the last the first.

    Rows meet in groups of neighbouring ids, and only the first row of a group
    travels to the group above it.  Evenly spread ids fall into groups by
    arithmetic; where a group would be large, or ids span more than half the long
    range, rows are range partitioned and staged instead.  The ring of groups (100,000
    rows at most) is the only thing ordered as a whole.
    """
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if not n:
        return docs.withColumn("next_text", F.col("text"))
    rows = max(ROWS, n // 100_000 + 1)
    keys = ["none", "down", "head", "mark"]
    d = docs.withColumns({"none": F.col("doc_id").isNull(), "down": F.bitwise_not("doc_id"), "head": F.left("text", F.lit(64)),
                          "mark": F.xxhash64("text")})              # ~x falls as x rises, without overflow
    span = (high or 0) - (low or 0) + 1
    if span < 1 << 62:
        wide = max(1, span * rows // n)
        even = d.withColumn("bucket", F.coalesce(-F.floor((F.col("doc_id") - F.lit(low or 0)) / F.lit(wide)).cast("long"), F.lit(1)))
        ring = written(even.groupBy("bucket").count(), "ring")
        if ring.agg(F.max("count")).first()[0] <= 16 * rows:
            return _handed_on(even, ring.select("bucket"), keys).select(*docs.columns, "next_text")
    d = d.withColumn("nth", F.monotonically_increasing_id())          # also copies with one id are dealt out
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), n // (16 * rows) + 1)
    keys.append("nth")
    d = written(d.repartitionByRange(parts, *(F.col(k).asc() for k in keys)).withColumn("bucket", F.spark_partition_id().cast("long")), "ranges")
    return _handed_on(d, d.select("bucket").distinct(), keys).select(*docs.columns, "next_text")


def _handed_on(d: DataFrame, ring: DataFrame, keys: list[str]) -> DataFrame:
    """``d`` plus next_text: the text of the row after it by (bucket, ``keys``), round the ring of buckets."""
    around = Window.orderBy("bucket")
    ring = ring.withColumn("below", F.coalesce(F.lead("bucket").over(around), F.first("bucket").over(around)))
    order = Window.partitionBy("bucket").orderBy(*keys)
    d = d.withColumns({"place": F.row_number().over(order), "lead_text": F.lead("text").over(order),
                       "last": F.lead(F.lit(1)).over(order).isNull()})
    heads = d.where("place = 1").select(F.col("bucket").alias("below"), F.col("text").alias("first_text"))
    heads = ring.join(heads, "below").select(F.col("bucket").alias("above"), "first_text")
    d = d.join(heads, (F.col("bucket") == F.col("above")) & F.col("last"), "left")
    return d.withColumn("next_text", F.when(F.col("last"), F.col("first_text")).otherwise(F.col("lead_text")))


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, edits (``differing`` leaves of the
    text against the edited text), edit_at (offset of the first of them).

    The edited text has its last third of code points (rounded down) replaced
    by as many from the start of the next document's text.  A null text is
    empty; edits is empty and edit_at null where every leaf of the text is in the
    edited text too.
    """
    d = docs.select(ident(doc_id).cast("long").alias("doc_id"), F.coalesce(ident(text), F.lit("")).alias("text"))
    d = with_next(d).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int"))
    d = d.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), third)))
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("a"),
                 tree(F.col("edited")).alias("b"), tree(F.col("next_text")).alias("c"))
    d = d.withColumn("edits", differing(F.col("a"), F.col("b")))
    d = d.select("doc_id", "n_chars", "edited_sha256", "edits", root(F.col("a")).alias("fingerprint"),
                 root(F.col("b")).alias("edited_fingerprint"), root(F.col("c")).alias("next_fingerprint"),
                 *(leaves(F.col(x)).alias(x) for x in "abc"))
    return d.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("a"), F.col("b"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("a"), F.col("c"), F.col("fingerprint") == F.col("next_fingerprint")).alias("near_next"),
                    "edits", F.array_min(F.transform("edits", lambda x: x["at"])).alias("edit_at"))
