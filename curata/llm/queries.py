"""Query keys of the operators: thin wrappers that derive the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (bpe, bytecnn, langid, licenses, linededup, lmscore, merkle, mixing, periodic, pii, rpforest, simhash,
               whitening)
from .common import WORD, table

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_license_scan")
def license_scan(spark, sf_dir):
    """The documents as a tree of files: a folder per source with one folder per
    100 ids below it; every fifth batch of 20 ids holds licence files, every
    fiftieth those of the sources themselves."""
    k = F.coalesce(F.col("doc_id"), F.lit(0))
    batch = F.floor(k / 20)
    top = F.coalesce("source", F.lit("unknown"))
    name = F.when(batch % 5 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("doc-"), k.cast("string"), F.lit(".txt")))
    deep = F.concat_ws("/", top, F.concat(F.lit("part-"), F.floor(k / 100).cast("string")), name)
    path = F.when(batch % 50 == 0, F.concat_ws("/", top, F.lit("LICENSE"))).otherwise(deep)
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("file_id", "doc_id")


@query("op2_rp_forest")
def rp_forest(spark, sf_dir):
    return rpforest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op3_merkle")
def merkle_fingerprints(spark, sf_dir):
    return merkle.compare_edits(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op5_lm_scoring")
def lm_scoring(spark, sf_dir):
    return lmscore.score(table(spark, sf_dir, "documents"))


@query("op6_line_dedup")
def line_dedup(spark, sf_dir):
    d = linededup.dedup(table(spark, sf_dir, "documents"), t=0.8)
    return d.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_byte_bpe")
def byte_bpe(spark, sf_dir):
    codec = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), codec)


@query("op8_simhash")
def simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_bits=4)


@query("op9_source_mix")
def source_mix(spark, sf_dir):
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


@query("op10_pii")
def personal_data(spark, sf_dir):
    return pii.summary(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def embedding_whitening(spark, sf_dir):
    d = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)
    return d.withColumn("deviation", F.expr("try_cast(deviation AS long)"))      # null beyond the long range


def with_planted_periods(docs):
    """doc_id and text of ``docs``, where every tenth text by crc32 of its id repeats a passage of itself to its end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    d = docs.select("doc_id", "text", g.alias("g"), (F.pmod(h, F.lit(10)) == 0).alias("chosen"))
    d = d.withColumn("words", F.when(F.col("chosen"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))))
    d = d.withColumn("n", F.greatest(F.size("words"), F.lit(0)).cast("long"))
    a = F.pmod(F.col("g"), F.greatest("n", F.lit(1)))
    d = d.withColumn("a", a).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8)))))
    rest = (F.col("n") - F.col("a")).cast("int")
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    passage = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    made = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(F.flatten(F.array_repeat(passage, times)), F.lit(1), rest))
    return d.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def periodic_runs(spark, sf_dir):
    d = periodic.detect(with_planted_periods(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    d = d.withColumn("best", best)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length, period = F.col("best.length"), -F.col("best.short")
    return d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), length.alias("length"),
                    period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op13_byte_cnn")
def byte_cnn(spark, sf_dir):
    return bytecnn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label="quality", threshold=0.3)
