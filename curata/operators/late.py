"""Late-arriving dimension members.

For a fact feed, keys that have no dimension row valid at the fact date get
a placeholder member ('NA' attributes, MIN_DATE ... OPEN_END validity, md5
surrogate).  Shape: distinct (key, date) of the increment -> point-in-
interval anti join (key equal AND date BETWEEN valid_from AND valid_through;
the range is a residual of the hash/sort-merge join on the key) -> distinct
keys -> constant projection.  Re-running is a no-op: the placeholder then
covers every date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_DATE, NA, OPEN_END, as_of_col


def _ts(v: str) -> Column:
    return F.lit(v).cast("timestamp_ntz")


def increment(fact: DataFrame, change_col: str, start=None, end=None) -> DataFrame:
    if start is None:
        return fact
    f = fact.where(F.col(change_col) >= F.lit(start).cast(fact.schema[change_col].dataType))
    if end is not None:
        f = f.where(F.col(change_col) <= F.lit(end).cast(fact.schema[change_col].dataType))
    return f


def missing_keys(fact_keys: DataFrame, dim: DataFrame, key: str, date: str, dim_key: str,
                 valid_from: str = "valid_from_date", valid_through: str = "valid_through_date") -> DataFrame:
    """Distinct fact keys with at least one date not covered by a dim row."""
    pairs = fact_keys.select(F.col(key).alias("_k"), F.col(date).alias("_d")).distinct()
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(valid_from).alias("_vf"), F.col(valid_through).alias("_vt"))
    cond = (pairs["_k"] == d["_dk"]) & pairs["_d"].between(d["_vf"], d["_vt"])
    return pairs.join(d, cond, "left_anti").select("_k").distinct()


def late_members(fact: DataFrame, dim: DataFrame, key: str, date: str, dim_key: str, as_of,
                 attributes: Sequence[str], id_col: str = "dim_id", id_prefix: str = "late_",
                 fixed: dict | None = None, window: tuple | None = None, change_col: str | None = None) -> DataFrame:
    """Placeholder members for fact keys missing from the dimension."""
    f = increment(fact, change_col or date, *(window or (None, None)))
    miss = missing_keys(f, dim, key, date, dim_key)
    return miss.select(
        F.md5(F.concat(F.lit(id_prefix), F.col("_k").cast("string"))).alias(id_col),
        *[F.lit(v).alias(k) for k, v in (fixed or {}).items()],
        F.col("_k").alias(dim_key),
        *[F.lit(NA).alias(a) for a in attributes],
        _ts(MIN_DATE).alias("valid_from_date"),
        _ts(OPEN_END).alias("valid_through_date"),
        as_of_col(as_of).alias("create_date"),
    )


def fallback_key(fact: DataFrame, lookup: DataFrame, fact_lookup_col: str, lookup_col: str, mapped_col: str,
                 own_key: str, out: str = "mapped_key") -> DataFrame:
    """``nvl(mapped key, own key)`` after a top-1 lookup (one row per
    lookup value, so the join cannot fan out)."""
    lk = lookup.select(F.col(lookup_col).alias("_lv"), F.col(mapped_col).alias("_mk"))
    j = fact.join(lk, fact[fact_lookup_col] == lk["_lv"], "left")
    return j.withColumn(out, F.coalesce(F.col("_mk"), F.col(own_key))).drop("_lv", "_mk")


def expand_calendar(fact: DataFrame, calendar: DataFrame, fact_period: str, cal_period: str, cal_day: str,
                    day_out: str = "day") -> DataFrame:
    """Week -> days expansion.  No hint: the planner broadcasts the distinct
    days when their measured size allows."""
    cal = calendar.select(F.col(cal_period).alias("_p"), F.col(cal_day).alias(day_out)).distinct()
    return fact.join(cal, fact[fact_period] == cal["_p"], "inner").drop("_p")
