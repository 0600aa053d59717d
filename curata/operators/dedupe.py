"""Latest row per key, versions per key, key validity.

``latest_per_key`` is ``row_number() == 1`` over a window.  Spark plans this
as a *partial* WindowGroupLimit before the shuffle, so every map task already
keeps only its top row per key: a key holding a third of all rows costs one
row per map partition in the exchange, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: Sequence, ties: Sequence = (), descending: bool = True) -> list[Column]:
    cols = []
    for c in list(order) + list(ties):
        c = F.col(c) if isinstance(c, str) else c
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return cols


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, ties: Sequence = ()) -> DataFrame:
    """Keep the newest row per key (order desc, then tie-break columns desc)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order, ties))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged; computing it fails if a (non-null) key repeats.

    The check numbers the rows of each key, at most two of which are ever
    looked at, on the partitioning that a join on the keys needs anyway.
    """
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(k) for k in keys]))
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    message = F.concat(F.lit(f"repeated key ({', '.join(keys)}): "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    fine = F.when(present & (F.col("_nth") > 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_nth", n).where(fine).drop("_nth")


# Skew handling for version numbering.  A window puts every row of a key in
# one task; a key with a third of all rows would stall the whole stage.  So a
# batch in which some key holds more than half an even partition's share takes
# another path: it is dealt into ranges of (keys, start, ties), whatever the key,
# and the first row of a key in a range is handed to the range before.  A seeded
# sample of the key columns only chooses the path; both give the same result.
SKEW_DEFAULTS = {
    "fraction": 0.001,       # sample for the largest key's share
    "partitions": None,      # n; None: the shuffle partition count
    "seed": 17,
}


def _partitions(df: DataFrame, n) -> int:
    return int(n or df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def has_hot_key(df: DataFrame, keys: Sequence[str], fraction: float = 0.001, partitions: int | None = None,
                seed: int = 17) -> bool:
    """Whether some key (null keys count as one) seems to hold over half an even partition's share of the rows."""
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    per = df.select(key).sample(fraction=fraction, seed=seed).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    top = per.agg(F.max("_n").alias("top"), F.sum("_n").alias("total")).first()        # one row
    return bool(top["top"] and top["top"] > 1 and top["top"] * 2 * _partitions(df, partitions) >= top["total"])


def _carried(ranges: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per (range, key) for keys that lie in several ranges: the key's first
    row of its next range (``_alive`` = 1 if there is one) and its rows in earlier
    ranges (``_off``).  Only the first and the last key of a range can go on, so
    these are at most two rows a range."""
    at = F.struct(*[F.col(c) for c in order])
    heads = ranges.groupBy("_part", *keys).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    line = Window.partitionBy(*keys).orderBy("_part")
    before = F.coalesce(F.sum("_cnt").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = heads.select("_part", *keys, F.lead("_first").over(line).alias("_first"),
                         F.lead(F.lit(1)).over(line).alias("_alive"), before.alias("_off"))
    heads = heads.where("_alive IS NOT NULL OR _off > 0")
    return heads.select("_part", *keys, F.col("_first").getField(order[0]).alias(order[0]), "_alive", "_off", F.lit(1).alias("_carry"))


def versions_per_key(df: DataFrame, keys: Sequence[str], start: str, ties: Sequence = (),
                     end_col: str = "end_time", current_col: str = "is_current",
                     version_col: str | None = "version", skew: str | bool | dict = "auto",
                     repeats: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """All versions kept: end = next version's start, newest is current.

    A window over the keys: one exchange.  ``skew="auto"`` looks for a key that
    holds a large share of the rows (``has_hot_key``); with one, or with
    ``skew=True`` or a dict of SKEW_DEFAULTS' settings, the rows are range
    partitioned on (keys, start, ties) and staged once under the shared folder, each
    range is windowed on its own, and the last row of a key in a range takes the
    key's first row of the next range.  No key is ever whole in one task then,
    not even rows tied in all of these, and the result is the same.

    ``repeats=(flag, columns)``: of rows alike in keys, start, ties and ``columns``,
    those whose integer column ``flag`` is 1 go, but for one if none has 0.  Then rows
    of one start and ties are ordered by ``flag``.
    """
    keys = list(keys)
    order = list(dict.fromkeys([start, *ties]))
    opts = {**SKEW_DEFAULTS, **(skew if isinstance(skew, dict) else {})}
    ranged = skew is True or isinstance(skew, dict) or (skew == "auto" and has_hot_key(df, keys, **opts))
    added = [c for c in (end_col, current_col, version_col) if c]
    cols = [c for c in df.columns if c not in added]
    by, b, more = keys, df, F.lit(1)
    last = [repeats[0]] if repeats else []
    alike_cols = [c for c in repeats[1] if c not in [*order, *keys]] if repeats else []
    if ranged:
        from ..sources.sinks import staged
        if repeats:                                    # copies within the flagged rows go before they meet in one range
            once = df.where(F.col(repeats[0]) == 1).dropDuplicates([*keys, *order, *alike_cols])
            df = df.where(F.col(repeats[0]) != 1).unionByName(once)
        else:
            df = df.withColumn("_nth", F.monotonically_increasing_id())
            order, last = [*order, "_nth"], []
        n = _partitions(df, opts["partitions"])
        ranges = df.repartitionByRange(n, *[F.col(c).asc() for c in [*keys, *order]]).withColumn("_part", F.spark_partition_id())
        ranges = staged(ranges, "ranges")              # the ranges are fixed from here on, also for a lost executor
        by, more, last = ["_part", *keys], F.col("_alive"), [*last, "_carry"]
        order = ["_carry", *order]
        b = (ranges.withColumns({"_alive": F.lit(1), "_carry": F.lit(0), "_off": F.lit(0).cast("bigint")})
             .unionByName(_carried(ranges, keys, order[1:]), allowMissingColumns=True))
    if repeats:
        same = [*order, *alike_cols]
        w = Window.partitionBy(*by).orderBy(*[F.col(c).asc() for c in [*same, repeats[0]]])
        alike = F.lag(F.lit(1)).over(w) == 1
        for c in same:
            alike = alike & F.lag(c).over(w).eqNullSafe(F.col(c))
        b = b.withColumn("_again", F.coalesce(alike & (F.col(repeats[0]) == 1), F.lit(False))).where("NOT _again").drop("_again")
    w = Window.partitionBy(*by).orderBy(*[F.col(c).asc() for c in [*order, *last]])
    goes_on = F.lead(more).over(w) == 1
    out = b.withColumns({end_col: F.when(goes_on, F.lead(start).over(w)),
                         current_col: F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)})
    if version_col:
        off = F.max("_off").over(Window.partitionBy(*by)) if ranged else F.lit(0)
        out = out.withColumn(version_col, (F.row_number().over(w) + off).cast("int"))
    if ranged:
        out = out.where("_carry = 0")
    return out.select(*cols, *added)


def key_validity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One aggregate row: null keys, rows, distinct keys, valid flag."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    agg = df.agg(
        F.count_if(any_null).alias("null_keys"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
    )
    return agg.withColumn("is_valid", (F.col("null_keys") == 0) & (F.col("distinct_keys") == F.col("row_count")))


def top_latest(df: DataFrame, order: Sequence, n: int = 1) -> DataFrame:
    """Top-n by order desc (a top-k report: the limit is the feature).

    orderBy + limit plans as TakeOrderedAndProject: a per-partition top-n,
    then a merge of n rows per partition.
    """
    return df.orderBy(*_order(order)).limit(n)
