"""Incremental windows and load watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import as_of_col


def _lit_like(df: DataFrame, col: str, value):
    return F.lit(value).cast(df.schema[col].dataType)


def window(df: DataFrame, col: str, start, end=None) -> DataFrame:
    """``col > start`` (open end) or ``col BETWEEN start AND end`` (closed);
    a plain predicate, so it reaches the parquet scan as a pushed filter."""
    if end is None:
        return df.where(F.col(col) > _lit_like(df, col, start))
    return df.where(F.col(col).between(_lit_like(df, col, start), _lit_like(df, col, end)))


def watermark_row(df: DataFrame, col: str, ids: dict, out_col: str = "change_date") -> DataFrame:
    """One watermark row: the identifying columns plus max(col) of the load.

    A global aggregate with map-side partials; the result is one row.
    """
    return df.agg(F.max(col).alias(out_col)).select(*[F.lit(v).alias(k) for k, v in ids.items()], out_col)


def read_watermark(marks: DataFrame, ids: dict, col: str = "change_date", default=None) -> DataFrame:
    """Latest watermark of one load (``default`` when none was written)."""
    m = marks
    for k, v in ids.items():
        m = m.where(F.col(k) == v)
    agg = m.agg(F.max(col).alias(col))
    if default is not None:
        agg = agg.select(F.coalesce(F.col(col), as_of_col(default)).alias(col))
    return agg


def process_window(spark: SparkSession, marks: DataFrame, ids: dict, as_of, col: str = "change_date"):
    """(from, to): from the stored watermark up to ``as_of``."""
    frm = read_watermark(marks, ids, col).first()[col]
    return frm, as_of
