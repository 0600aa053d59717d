"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of equal slots of ``block`` words.  Slot k draws the point
frac(k * golden ratio), which falls into one source's part of the cumulative
weights; the r-th slot of a source takes the r-th block of that source's
shuffled documents laid end to end, over and over for up to ``cap`` rounds.
Golden-ratio points are spread so evenly that every prefix of the mix has
each source close to its share.

A source may hold most rows, so nothing works per source in one task: ranks
and offsets are running sums within (source, chunk) plus the chunk totals
before, and blocks meet slots on (source, block number), one slot a key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, ident, joined, written

GOLDEN = (math.sqrt(5) - 1) / 2                       # 0.618...
_STEP = (GOLDEN * (1 << 20)) % 1.0                    # GOLDEN * 2**20 without its whole part
SLOT_CHUNK = 1 << 16                                  # slots ranked together
DOC_CHUNK = 1 << 13                                   # documents of a source added up together, about


@dataclass
class Mix:
    rows: DataFrame        # one per input row: doc_id, mark, copy, size, source_no, source_size, target, start
    blocks: DataFrame      # slot, source_no, start, round, first_word, words
    sources: DataFrame     # source (null stays), source_no, weight, source_size, target


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def point(k: Column) -> Column:
    """frac(k * golden ratio), in two parts so that large k keep their precision."""
    part = F.shiftright(k, 20) * F.lit(_STEP)
    x = (part - F.floor(part)) + k.bitwiseAND(F.lit((1 << 20) - 1)) * F.lit(GOLDEN)
    return x - F.floor(x)


def source_key(source: Column) -> Column:
    """Orders sources by code point with null last, and never is null."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """``sizes`` (source_key, source_size) with source_no, weight and target.

    Weights repeat over the sources in key order.  All words are shared by
    weight; a target stops at ``cap`` times its source and the excess goes to
    the others by weight, until none is above.  One row per source: the
    numbering and the rounds work on that small table only.
    """
    n = F.row_number().over(Window.orderBy("source_key")) - 1
    s = sizes.withColumn("source_no", n).withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_no") % len(weights) + 1).cast("int")))
    s = written(s, "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while total:
        above = F.lit(share) * F.col("weight") > cap * F.col("source_size")
        if full < 0:
            above = F.lit(False)
        stops, used, rest = s.agg(F.count_if(above), F.sum(F.when(above, cap * F.col("source_size")).otherwise(0)),
                                  F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if stops == full or not rest:
            break
        share, full = (total - used) / rest, stops
    return s.withColumn("target", F.least(F.lit(share) * F.col("weight"), (cap * F.col("source_size")).cast("double")))


def mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, block: int = 64,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    """Schedule all words of ``docs``; see :class:`Mix` for the parts.

    Null and blank texts have size 0 and are never taken.  Null sources form
    one source, the last.  Repeated rows are separate documents.  The order of
    documents within a source follows a hash of id and text, so reruns agree.
    An empty input gives empty parts.
    """
    spark = docs.sparkSession
    d = docs.select(ident(doc_id).alias("doc_id"), source_key(ident(source)).alias("source_key"),
                    word_count(ident(text)).alias("size"), row_mark(ident(doc_id), ident(source), ident(text)).alias("mark"))
    d = written(d.withColumn("copy", F.row_number().over(Window.partitionBy("mark").orderBy("doc_id"))), "sizes")
    per = targets(d.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, cap)
    share = F.sum("target").over(Window.orderBy("source_no"))
    n_rows, n_sources = d.count(), per.count()
    total = per.agg(F.sum("source_size")).first()[0] or 0
    high = F.coalesce(F.try_divide(share, F.sum("target").over(Window.partitionBy())), F.lit(0.0))
    per = written(per.withColumn("high", high).withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("source_no"))), "shares")

    slots = written(_slots(spark, per, -(-total // block), n_sources), "slots")
    most = slots.groupBy("source_no").agg(F.count("*").alias("slots"))
    rows = written(_offsets(d.join(per.select("source_key", "source_no", "source_size", "target"), "source_key"), n_rows)
                   .drop("source_key"), "rows")

    live = joined(rows.where("size > 0"), most, n_sources, "source_no").select("doc_id", "source_no", "source_size", "size", "start", "slots",
                                                                F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("round"))
    begin = F.col("round") * F.col("source_size") + F.col("start")
    live = live.withColumn("begin", begin).withColumn("end", F.col("begin") + F.col("size")).where(F.col("begin") < F.col("slots") * block)
    last = F.least(F.floor((F.col("end") - 1) / block), F.col("slots") - 1)
    pieces = live.withColumn("rank", F.explode(F.sequence(F.floor(F.col("begin") / block), last)))
    at = F.greatest("begin", F.col("rank") * block)
    blocks = pieces.join(slots, ["source_no", "rank"]).select(
        "slot", "source_no", "doc_id", "start", "round", (at - F.col("begin")).alias("first_word"),
        (F.least("end", (F.col("rank") + 1) * block) - at).alias("words"))
    sources = per.select(F.when(F.col("source_key") != "1", F.substring("source_key", 2, 1 << 30)).alias("source"),
                         "source_no", "weight", "source_size", "target")
    return Mix(rows, blocks, sources)


def row_mark(doc_id: Column, source: Column, text: Column) -> Column:
    return F.xxhash64(F.lit("mix"), doc_id, F.lit("|"), source, F.lit("|"), text)


def _slots(spark, per: DataFrame, n: int, n_sources: int) -> DataFrame:
    """(slot, source_no, rank): each slot's source by its point, ranked per source."""
    cells = 1 << max(4, (4 * n_sources).bit_length())      # a grid over [0, 1): points and sources meet by cell
    parts = per.where("high > low").select(
        "source_no", "low", F.when(F.col("high") >= 1 - 1e-12, F.lit(2.0)).otherwise(F.col("high")).alias("high"),
        F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))).alias("cell"))
    slots = spark.range(n).select(F.col("id").alias("slot"), point(F.col("id")).alias("at"))
    slots = slots.withColumn("cell", F.floor(F.col("at") * cells)).join(parts, "cell").where("at >= low AND at < high")
    slots = slots.select("slot", "source_no", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"))
    before = F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    chunks = slots.groupBy("source_no", "chunk").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    return (slots.withColumn("rank", rank).join(chunks, ["source_no", "chunk"])
            .select("slot", "source_no", (F.col("rank") + F.col("before")).alias("rank")))


def _offsets(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with start: the words before the document in its source's shuffled order."""
    bits = max(1, (n_rows // DOC_CHUNK).bit_length())
    d = rows.withColumn("shuffle", F.xxhash64(F.lit("shuffle"), "mark", "copy"))
    d = d.withColumn("chunk", F.shiftright("shuffle", 64 - bits))
    ahead = F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    chunks = d.groupBy("source_no", "chunk").agg(F.sum("size").alias("n")).withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    inner = F.sum("size").over(Window.partitionBy("source_no", "chunk").orderBy("shuffle", "doc_id", "mark", "copy")
                               .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("inner", F.coalesce(inner, F.lit(0))).join(chunks.drop("n"), ["source_no", "chunk"])
            .withColumn("start", F.col("inner") + F.col("ahead")).drop("inner", "ahead", "chunk", "shuffle"))


def taken(m: Mix) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words, repeats counted)."""
    got = m.blocks.groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    live = m.rows.where("size > 0").join(got, ["source_no", "start"], "left")
    out = ["doc_id", "size", "source_size", "target"]
    return live.select(*out, F.coalesce("taken", F.lit(0)).cast("long").alias("taken")).union(
        m.rows.where("size = 0").select(*out, F.lit(0).cast("long")))


def apply_mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, block: int = 64,
              doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents, in the columns of ``docs``: a row for every round in
    which a document is taken.  Where a source's last block ends within a
    document, that row holds the words taken, one space apart."""
    m = mix(docs, weights, cap, block, doc_id, text, source)
    got = m.blocks.groupBy("source_no", "start", "round").agg(F.sum("words").alias("words"))
    got = m.rows.where("size > 0").join(got, ["source_no", "start"]).select("mark", "copy", "size", "words")
    mark, copy, size, words = fresh(docs.columns, "mark", "copy", "size", "words")
    got = got.select(F.col("mark").alias(mark), F.col("copy").alias(copy), F.col("size").alias(size), F.col("words").alias(words))
    full = docs.withColumn(mark, row_mark(ident(doc_id), ident(source), ident(text)))
    full = full.withColumn(copy, F.row_number().over(Window.partitionBy(mark).orderBy(ident(doc_id))))
    cut = F.array_join(F.slice(F.regexp_extract_all(ident(text), F.lit(WORD), F.lit(0)), F.lit(1), F.col(words).cast("int")), " ")
    shown = F.when(F.col(words) < F.col(size), cut).otherwise(ident(text))
    return full.join(got, [mark, copy]).select(*(shown.alias(c) if c == text else ident(c) for c in docs.columns))
