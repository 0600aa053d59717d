"""Sorted lists per key in parts of bounded length.

A list per key is one value, however many entries the key has.  Here a key's
sorted distinct entries are cut into parts that each hold at most ``per_part`` of
them, so no row and no task grows with a key; a reader that wants the whole list
joins the parts (``joined``), for the keys it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import staged

PER_PART = 10_000


def parts(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str = "entries", per_part: int = PER_PART) -> DataFrame:
    """(keys, part long, ``out`` array<struct of ``cols``>) of distinct ``rows``: entries in rising
    order within a part, and the parts of a key in rising ``part`` (numbers have gaps).

    Keys of up to ``per_part`` entries have the one part 0.  If a key has more, rows are range
    partitioned on (keys, entry) and staged, so a long list is dealt over as many
    tasks as it has ranges.  Null keys are a key.
    """
    if per_part < 1:
        raise ValueError("per_part must be at least 1")
    keys, cols = list(keys), list(cols)
    entry = F.struct(*cols)
    rows = rows.select(*keys, *cols)
    longest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if (longest or 0) <= per_part:
        return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(out)).select(*keys, F.lit(0).cast("bigint").alias("part"), out)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranges = staged(rows.repartitionByRange(n, *[F.col(c).asc() for c in [*keys, *cols]]).withColumn("_part", F.spark_partition_id()), "lists")
    nth = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*cols))
    chunk = ranges.withColumn("_chunk", F.floor((nth - 1) / per_part).cast("bigint"))
    got = chunk.groupBy("_part", *keys, "_chunk").agg(F.sort_array(F.collect_list(entry)).alias(out))
    return got.select(*keys, (F.shiftleft(F.col("_part").cast("bigint"), 32) + F.col("_chunk")).alias("part"), out)


def joined(lists: DataFrame, keys: Sequence[str], out: str = "entries") -> DataFrame:
    """Whole lists again, one row per key: for a reader that has chosen the keys it can hold."""
    by = F.sort_array(F.collect_list(F.struct("part", out)))
    return lists.groupBy(*keys).agg(F.flatten(F.transform(by, lambda x: x[out])).alias(out))
