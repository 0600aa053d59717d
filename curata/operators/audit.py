"""Audit and reconciliation rows.

Counts are aggregates computed by Spark (one job per frame, map-side
partials); only the single result row is ever brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import as_of_col

FACT_SCHEMA = ("sla_dim_id bigint, audit_record_type_desc string, audit_timestamp timestamp_ntz, "
               "audit_value bigint, valid_flag string, audit_dim_id bigint")


def event_rows(spark: SparkSession, events: Sequence[tuple], sla_dim_id: int, audit_dim_id: int) -> DataFrame:
    """Audit event rows (pipeline start/end, phase start/end): (type, time)."""
    import datetime as dt
    rows = [(sla_dim_id, kind, dt.datetime.fromisoformat(str(t)), None, "Y", audit_dim_id) for kind, t in events]
    return spark.createDataFrame(rows, FACT_SCHEMA)


def count_row(df: DataFrame, kind: str, as_of, sla_dim_id: int, audit_dim_id: int, valid_flag: str = "Y") -> DataFrame:
    """One audit count row for a frame."""
    return df.agg(F.count(F.lit(1)).alias("audit_value")).select(
        F.lit(sla_dim_id).cast("bigint").alias("sla_dim_id"), F.lit(kind).alias("audit_record_type_desc"),
        as_of_col(as_of).alias("audit_timestamp"), "audit_value", F.lit(valid_flag).alias("valid_flag"),
        F.lit(audit_dim_id).cast("bigint").alias("audit_dim_id"))


def dim_rows(loads: DataFrame, prefix: str = "") -> DataFrame:
    """Audit dimension rows of loads (table_name, data_product_name,
    source_table_name, target_table_name); a name prefix is cut off."""
    name = F.col("table_name")
    if prefix:
        name = F.when(F.startswith(name, F.lit(prefix)), F.substring(name, F.lit(len(prefix) + 1), F.length(name))).otherwise(name)
    return loads.select(name.alias("table_name"), "data_product_name", "source_table_name", "target_table_name")


def dim_row(spark: SparkSession, table_name: str, data_product: str, source: str, target: str,
            prefix: str = "") -> DataFrame:
    """Audit dimension row for one load."""
    row = spark.createDataFrame([(table_name, data_product, source, target)],
                                "table_name string, data_product_name string, source_table_name string, "
                                "target_table_name string")
    return dim_rows(row, prefix)


def latest_ids(audit_dim: DataFrame, targets: DataFrame, id_col: str = "audit_dim_id",
               target_col: str = "target_table_name", default: int = 0) -> DataFrame:
    """Latest audit id per target (``default`` for targets never audited)."""
    mx = audit_dim.groupBy(target_col).agg(F.max(id_col).alias("_mx"))
    return (targets.join(mx, target_col, "left")
            .select(target_col, F.coalesce(F.col("_mx"), F.lit(default).cast("bigint")).alias("latest_audit_id")))


def tagged_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of each named frame, in a single job:
    the frames are tagged, unioned and counted with count_if."""
    tagged = None
    for name, df in frames.items():
        t = df.select(F.lit(name).alias("_tag"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(*[F.count_if(F.col("_tag") == name).alias(name) for name in frames])


def load_counts(source: DataFrame, target_before: DataFrame, target_after: DataFrame) -> DataFrame:
    return tagged_counts({"source_count": source, "target_before": target_before, "target_after": target_after})


def dedupe_counts(df: DataFrame, batch_col, keys: Sequence[str]) -> DataFrame:
    """Raw versus de-duplicated rows per batch (de-duplicated = distinct keys)."""
    b = batch_col if not isinstance(batch_col, str) else F.col(batch_col)
    return (df.withColumn("batch_id", b).groupBy("batch_id")
            .agg(F.count(F.lit(1)).alias("raw_count"), F.count_distinct(*[F.col(k) for k in keys]).alias("dedup_count")))


def action_counts(merged: DataFrame, action_col: str) -> DataFrame:
    return merged.groupBy(action_col).agg(F.count(F.lit(1)).alias("n"))


def counted(merged: DataFrame, action_col: str, actions: Sequence[str] = ("KEEP", "UPDATE", "INSERT")):
    """(``merged`` without its action column, Observation of the rows per action): the
    counts come while the result is written, the merge is not run again for them."""
    from pyspark.sql import Observation
    obs = Observation()
    seen = merged.observe(obs, *[F.count_if(F.col(action_col) == a).alias(a) for a in actions])
    return seen.drop(action_col), obs


def counts_row(spark: SparkSession, actions: dict[str, int]) -> DataFrame:
    """source_count, target_before and target_after from the action counts of an upsert."""
    keep, update, insert = (actions.get(a, 0) for a in ("KEEP", "UPDATE", "INSERT"))
    return spark.createDataFrame([(update + insert, keep + update, keep + update + insert)],
                                 "source_count bigint, target_before bigint, target_after bigint")


def reconcile(source: DataFrame, query: DataFrame, strict: bool = False) -> DataFrame:
    """Source count must equal query count; with ``strict`` a mismatch raises
    when the row is evaluated, since the check is part of ``is_reconciled``."""
    c = tagged_counts({"source_count": source, "query_count": query})
    ok = F.col("source_count") == F.col("query_count")
    if strict:
        text = F.concat(F.lit("source and query counts differ: "), F.col("source_count"), F.lit(" and "), F.col("query_count"))
        ok = F.when(ok, True).otherwise(F.raise_error(text).cast("boolean"))
    return c.withColumn("is_reconciled", ok)


def explode_metrics(df: DataFrame, keys: Sequence[str], map_col: str, key_name: str = "metric",
                    value_name: str = "value") -> DataFrame:
    return df.select(*keys, F.explode(map_col).alias(key_name, value_name))
