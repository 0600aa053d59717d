"""Query keys: audit rows, counts, reconciliation, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, scd
from ..session import scratch_path
from .inputs import AS_OF, LI_KEYS, li_batch, src_orders, table, tgt_orders, with_
from .registry import query
from .q_dims import STAGED, _staged

T = f"TIMESTAMP '{AS_OF}'"
PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("audit_fact_rows", f"""
SELECT CAST(7 AS BIGINT) AS sla_dim_id, 'pipeline start' AS audit_record_type_desc,
  TIMESTAMP '2001-12-31 23:00:00' AS audit_timestamp, CAST(NULL AS BIGINT) AS audit_value, 'Y' AS valid_flag,
  CAST(42 AS BIGINT) AS audit_dim_id
UNION ALL SELECT 7, 'pipeline end', {T}, NULL, 'Y', 42
UNION ALL SELECT 7, 'source_row_count', {T}, count(*), 'Y', 42 FROM lineitem
UNION ALL SELECT 7, 'target_row_count', {T}, count(*), 'Y', 42 FROM
  (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def audit_fact_rows(spark, d):
    li = li_batch(spark, d)
    ev = audit.event_rows(spark, [("pipeline start", "2001-12-31 23:00:00"), ("pipeline end", AS_OF)], 7, 42)
    return (ev.unionByName(audit.count_row(li, "source_row_count", AS_OF, 7, 42))
            .unionByName(audit.count_row(li.select(*LI_KEYS).distinct(), "target_row_count", AS_OF, 7, 42)))


@query("audit_latest_id", f"""
SELECT t.target_table_name, coalesce(max(a.audit_dim_id), 0) AS latest_audit_id
FROM (SELECT * FROM (VALUES {', '.join(f"('tgt_{p}')" for p in PRIOS + ['none'])}) v(target_table_name)) t
LEFT JOIN (SELECT o_orderkey AS audit_dim_id, 'tgt_' || o_orderpriority AS target_table_name FROM orders) a
  ON t.target_table_name = a.target_table_name
GROUP BY t.target_table_name""")
def audit_latest_id(spark, d):
    dim = table(spark, d, "orders").select(F.col("o_orderkey").alias("audit_dim_id"),
                                           F.concat(F.lit("tgt_"), "o_orderpriority").alias("target_table_name"))
    targets = spark.createDataFrame([(f"tgt_{p}",) for p in PRIOS + ["none"]], "target_table_name string")
    return audit.latest_ids(dim, targets)


@query("audit_counts", with_("tgt_orders", "src_orders") + """
SELECT (SELECT count(*) FROM src_orders) AS source_count, (SELECT count(*) FROM tgt_orders) AS target_before,
  (SELECT count(*) FROM (SELECT o_orderkey FROM tgt_orders t WHERE NOT EXISTS
     (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey) UNION ALL SELECT o_orderkey FROM src_orders)) AS target_after""")
def audit_counts(spark, d):
    """Counted while the merged snapshot is written."""
    merged = scd.scd1_full_join(tgt_orders(spark, d), src_orders(spark, d), ["o_orderkey"], action_col="action")
    new, seen = audit.counted(merged, "action")
    new.write.parquet(scratch_path(spark, "audit-counts"))
    return audit.counts_row(spark, seen.get)


@query("audit_dim_rows", """
SELECT DISTINCT o_orderpriority AS table_name, 'sales' AS data_product_name, 'landing.' || o_orderstatus AS source_table_name,
  'curated.tgt_' || o_orderpriority AS target_table_name FROM orders""")
def audit_dim_rows(spark, d):
    """One audit dimension row per load, the loads taken from the orders' priorities and states."""
    pairs = table(spark, d, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    loads = pairs.select(F.concat(F.lit("tgt_"), "o_orderpriority").alias("table_name"), F.lit("sales").alias("data_product_name"),
                         F.concat(F.lit("landing."), "o_orderstatus").alias("source_table_name"),
                         F.concat(F.lit("curated.tgt_"), "o_orderpriority").alias("target_table_name"))
    return audit.dim_rows(loads, "tgt_")


@query("audit_dedupe_counts", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS batch_id, count(*) AS raw_count,
  count(DISTINCT (l_orderkey, l_linenumber)) AS dedup_count FROM lineitem GROUP BY 1""")
def audit_dedupe_counts(spark, d):
    return audit.dedupe_counts(li_batch(spark, d), F.year("l_shipdate"), LI_KEYS)


@query("audit_merge_counts", STAGED + "SELECT load_type, count(*) AS n FROM staged GROUP BY load_type")
def audit_merge_counts(spark, d):
    return audit.action_counts(_staged(spark, d), "load_type")


@query("audit_reconcile", """
SELECT (SELECT count(*) FROM orders) AS source_count, (SELECT count(*) FROM orders WHERE o_totalprice > 0) AS query_count,
  (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_totalprice > 0) AS is_reconciled
UNION ALL
SELECT (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F'),
  (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F')""")
def audit_reconcile(spark, d):
    """All orders against two target queries: one that has them all, one that lost some."""
    o = table(spark, d, "orders")
    good = audit.reconcile(o, o.where("o_totalprice > 0"), strict=True)
    return good.unionByName(audit.reconcile(o, o.where("o_orderstatus <> 'F'")))


@query("metrics_explode", "SELECT user_id, event_type AS metric, count(*) AS value FROM events GROUP BY user_id, event_type")
def metrics_explode(spark, d):
    ev = table(spark, d, "events")
    per = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return audit.explode_metrics(maps, ["user_id"], "m")
