"""Registry of query keys: name -> (spark callable, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the DuckDB text of the same result (omitted when not SQL-expressible)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def comparable(df, decimals=(), dates=()):
    """Present DECIMAL columns as double and DATE columns as timestamp.

    Result comparisons may read both engines through pandas, where DuckDB
    turns DECIMAL into float64 and DATE into datetime64 while Spark keeps
    Decimal and date objects.  The operator's own casts still run; only the
    final presentation changes, identically in the oracle SQL.
    """
    from pyspark.sql import functions as F
    cols = {c: F.col(c).cast("double") for c in decimals}
    cols.update({c: F.col(c).cast("timestamp_ntz") for c in dates})
    return df.withColumns(cols) if cols else df
