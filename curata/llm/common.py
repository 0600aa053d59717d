"""Helpers shared by the training-data operators.

Every operator takes the columns it needs by name and renames them at once, so
extra columns of the input (whatever their names) cannot clash with its own.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"      # fixed value: the word pattern of the query contracts
ARROW_ROWS = 500                 # rows per Arrow batch: bounds a Python task's memory on long texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_ready(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Let Python tasks import this library wherever they run (its archive goes
    out once with the job's files), and hand them texts in small Arrow batches."""
    sc = spark.sparkContext
    if not getattr(sc, "_curata_sent", False):
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='curata-code-')}/curata", "zip", package.parent, package.name)
        sc.addPyFile(archive)
        sc._curata_sent = True
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by spark.checkpoint.dir."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back.

    The files live where every executor sees them, so a lost executor costs a
    re-read and not a recomputation, and later joins see the measured size.
    Once written, the shuffle files behind them are released.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    release, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", None
    try:
        before = spark.conf.get(release, "false")
        spark.conf.set(release, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(release, before or "false")
    return spark.read.schema(df.schema).parquet(path)


SMALL = 500_000                  # rows of a few longs that may be broadcast (some 30 MB)


def joined(df: DataFrame, side: DataFrame, rows: int, on, how: str = "inner") -> DataFrame:
    """Join with a narrow side of ``rows`` counted rows: broadcast while that is few, else by shuffle."""
    return df.join(F.broadcast(side) if rows <= SMALL else side, on, how)


def packed(df: DataFrame, rows: int, per_task: int = 200_000) -> DataFrame:
    """``df``, of about ``rows`` rows, in no more tasks than they need."""
    return df.coalesce(1 + rows // per_task)


def fresh(taken, *names: str) -> list[str]:
    """``names``, each lengthened until it clashes with no column of ``taken``."""
    low = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in low:
            n += "_"
        low.add(n.lower())
        out.append(n)
    return out


def ident(name: str):
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def hash_fold(col, folds: int):
    """crc32 of a value's text modulo ``folds`` (null ids: fold of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def let(value, use):
    """``use`` of an expression that is computed once, however often ``use`` (also
    inside other lambdas) refers to it."""
    return F.transform(F.array(value), use)[0]


CHUNK = 32                       # lengths summed up in one go by ``starts``


def starts(lengths):
    """Where pieces of these ``lengths`` (array<bigint>) start when they stand one after the
    other, from 0.  Sums go chunk by chunk, so no element costs more than CHUNK steps."""
    zero = F.lit(0).cast("bigint")

    def total(a):
        return F.aggregate(a, zero, lambda t, x: t + x)

    def chunked(a):
        each = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / CHUNK).cast("int") - 1, F.lit(0)))
        return F.transform(each, lambda c: F.slice(a, c * CHUNK + 1, F.lit(CHUNK)))

    def placed(z):
        return F.flatten(F.transform(z["chunks"], lambda ch, c: let(
            F.struct(total(F.slice(z["long"], F.lit(1), c)).alias("at"), ch.alias("ch")),
            lambda y: F.transform(y["ch"], lambda x, i: y["at"] + total(F.slice(y["ch"], F.lit(1), i))))))
    return let(let(let(lengths, chunked), lambda ch: F.struct(ch.alias("chunks"), F.transform(ch, total).alias("long"))), placed)
