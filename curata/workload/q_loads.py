"""Query keys: configured loads of every type, late and repeated batches,
partitioned snapshots, rule catalogs applied, landing with history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe, scd
from ..operators import quality as Q
from ..plans import flows, loader, state
from ..session import scratch_path
from ..sources import sinks
from .inputs import AS_OF, LI_KEYS, LI_ORDER, LI_TIES, SPLIT, dirty_orders, li_batch, li_hist, li_new, src_orders, table, tgt_orders, with_
from .q_quality import _value_rows
from .q_scd import LI_DIFF, LI_ON, LI_VALUES, LI_W_ASC, LI_W_DESC, ORD_DIFF, _li_scd_src
from .q_streams import _waves
from .registry import query
from .sqlgen import md5_of

VERSIONS = f"""SELECT *, l_shipdate AS start_time, 0 AS is_deleted, lead(l_shipdate) OVER ({LI_W_ASC}) AS end_time,
  CASE WHEN lead(l_shipdate) OVER ({LI_W_ASC}) IS NULL THEN 1 ELSE 0 END AS is_current FROM lineitem"""


# ------------------------------------------------------------------ snapshots
@query("sink_snapshot_partitioned", with_("li_hist") + "SELECT *, 'plain' AS kind FROM li_hist UNION ALL SELECT *, 'bucketed' FROM li_hist")
def sink_snapshot_partitioned(spark, d):
    """Two publishes of a partitioned, and of a partitioned and bucketed, history; the second reads the first."""
    out = None
    for kind, bucket in (("plain", None), ("bucketed", (4, LI_KEYS))):
        root = scratch_path(spark, f"snapshot-{kind}")
        name = f"curata_snap_{kind}_" + root.rsplit("-", 1)[-1]
        hist = li_hist(spark, d)
        sinks.publish_snapshot(spark, hist.where("is_current = 1"), name, root, partition_by=["is_current"], bucket_by=bucket)
        both = spark.table(name).unionByName(hist.where("is_current = 0"))
        sinks.publish_snapshot(spark, both, name, root, partition_by=["is_current"], bucket_by=bucket)
        got = spark.table(name).withColumn("kind", F.lit(kind))
        out = got if out is None else out.unionByName(got)
    return out


# ------------------------------------------------------- late and repeated loads
@query("scd2_late_rows", "WITH t AS (" + VERSIONS + f""" WHERE l_shipdate >= TIMESTAMP '{SPLIT}'),
o AS (SELECT * FROM t WHERE is_current = 1),
f AS (SELECT l_orderkey, l_linenumber, min(start_time) AS f FROM t GROUP BY ALL),
s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({LI_W_DESC}) rn FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT}') WHERE rn = 1)
SELECT * FROM t UNION ALL BY NAME
SELECT s.*, s.l_shipdate AS start_time, 0 AS is_deleted, f.f AS end_time, CASE WHEN o.l_orderkey IS NULL THEN 1 ELSE 0 END AS is_current
FROM s LEFT JOIN o ON {LI_ON} LEFT JOIN f ON f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber
WHERE o.l_orderkey IS NULL OR ({LI_DIFF})""")
def scd2_late_rows(spark, d):
    """Rows older than the whole history of their key arrive after it."""
    target = scd.scd2_first_load(_li_scd_src(li_new(spark, d)), LI_KEYS, "start_time", LI_TIES)
    old = li_batch(spark, d).where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz"))
    late = _li_scd_src(dedupe.latest_per_key(old, LI_KEYS, LI_ORDER, LI_TIES))
    return scd.scd2(target, late, LI_KEYS, "start_time", compare=LI_VALUES)


@query("scd2_reload", "SELECT DISTINCT * FROM (" + VERSIONS.replace("FROM lineitem", "FROM (SELECT DISTINCT * FROM lineitem)") + ")")
def scd2_reload(spark, d):
    """The same versions arrive twice, the second time with older ones of their keys."""
    new = li_new(spark, d)
    hot = dedupe.has_hot_key(new, LI_KEYS)              # else copies meet where the versions of their key do: one exchange
    one = _li_scd_src((new if hot else new.repartition(*LI_KEYS)).distinct())
    first = sinks.staged(scd.scd2_first_load(one, LI_KEYS, "start_time", LI_TIES, skew="auto" if hot else False), "first-load")
    return scd.scd2_versions(first, _li_scd_src(li_batch(spark, d).distinct()), LI_KEYS, "start_time", LI_TIES)


@query("scd1_extra_columns", with_("tgt_orders", "src_orders") + """
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CAST(CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS BIGINT) AS o_custkey, t.o_orderpriority AS note
FROM tgt_orders t FULL JOIN src_orders s ON t.o_orderkey = s.o_orderkey""")
def scd1_extra_columns(spark, d):
    """The target has a column that the batch lacks, and wider types."""
    t = tgt_orders(spark, d).select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("bigint").alias("o_custkey"), F.col("o_orderpriority").alias("note"))
    s = src_orders(spark, d).select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("int").alias("o_custkey"))
    return scd.scd1_full_join(t, s, ["o_orderkey"])


# ----------------------------------------------------------- configured loads
def _landed(spark, d, name):
    path = scratch_path(spark, name)
    table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")).write.parquet(f"{path}/1")
    table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz")).write.parquet(f"{path}/2")
    return path


@query("pipe_scd2", VERSIONS)
def pipe_scd2(spark, d):
    """Two configured type-2 loads, one after the other."""
    path = _landed(spark, d, "pipe-scd2")
    target = None
    for part in ("1", "2"):
        config = {"source": {"source_table_type": "path", "path": f"{path}/{part}"},
                  "load": {"type": "scd2", "keys": LI_KEYS, "order": LI_ORDER, "ties": LI_TIES}}
        target = loader.run_load(spark, config, target)
    return target


@query("pipe_full_compare", with_("tgt_orders", "src_orders", extra={
    "t": "SELECT *, o_orderdate AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, 1 AS is_current, 0 AS is_deleted FROM tgt_orders",
}) + f"""
SELECT t.* FROM t JOIN src_orders s ON t.o_orderkey = s.o_orderkey WHERE NOT ({ORD_DIFF})
UNION ALL BY NAME
SELECT t.* REPLACE (TIMESTAMP '{AS_OF}' AS end_time, 0 AS is_current)
FROM t JOIN src_orders s ON t.o_orderkey = s.o_orderkey WHERE {ORD_DIFF}
UNION ALL BY NAME
SELECT s.*, s.o_orderdate AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, 1 AS is_current, 0 AS is_deleted
FROM src_orders s LEFT JOIN t ON t.o_orderkey = s.o_orderkey WHERE t.o_orderkey IS NULL OR ({ORD_DIFF})
UNION ALL BY NAME
SELECT t.* REPLACE (TIMESTAMP '{AS_OF}' AS end_time, 0 AS is_current, 1 AS is_deleted)
FROM t WHERE NOT EXISTS (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey)""")
def pipe_full_compare(spark, d):
    """A first configured full load, then a second one compared with it."""
    path = scratch_path(spark, "pipe-full-compare")
    tgt_orders(spark, d).write.parquet(f"{path}/1")
    src_orders(spark, d).write.parquet(f"{path}/2")
    target = None
    for part in ("1", "2"):
        config = {"source": {"source_table_type": "path", "path": f"{path}/{part}"},
                  "load": {"type": "full_compare", "keys": ["o_orderkey"], "order": ["o_orderdate"], "as_of": AS_OF}}
        target = loader.run_load(spark, config, target)
    return target


@query("pipe_targets", with_("tgt_orders", "src_orders", extra={
    "lat": "SELECT coalesce(s.o_orderkey, t.o_orderkey) AS k, CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS price "
           "FROM tgt_orders t FULL JOIN src_orders s ON t.o_orderkey = s.o_orderkey",
}) + f"""
SELECT 'type1' AS load, k AS o_orderkey, price AS o_totalprice, 1 AS is_current FROM lat
UNION ALL SELECT 'everything', o_orderkey, o_totalprice, 1 FROM tgt_orders
UNION ALL SELECT 'everything', o_orderkey, o_totalprice, 1 FROM src_orders
UNION ALL SELECT 'replaced', o_orderkey, o_totalprice, 1 FROM src_orders
UNION ALL SELECT 'compared', t.o_orderkey, t.o_totalprice, CASE WHEN s.o_orderkey IS NULL OR ({ORD_DIFF}) THEN 0 ELSE 1 END
  FROM tgt_orders t LEFT JOIN src_orders s ON t.o_orderkey = s.o_orderkey
UNION ALL SELECT 'compared', s.o_orderkey, s.o_totalprice, 1 FROM src_orders s LEFT JOIN tgt_orders t ON t.o_orderkey = s.o_orderkey
  WHERE t.o_orderkey IS NULL OR ({ORD_DIFF})""")
def pipe_targets(spark, d):
    """One source, twice, into four tables with a load type each; the tables move together."""
    root = scratch_path(spark, "pipe-targets")
    tgt_orders(spark, d).write.parquet(f"{root}/1")
    src_orders(spark, d).write.parquet(f"{root}/2")
    load = {"keys": ["o_orderkey"], "order": ["o_orderdate"], "as_of": AS_OF}
    tag = root.rsplit("-", 1)[-1]
    kinds = {"type1": "update", "everything": "append", "replaced": "complete", "compared": "full_compare"}
    for part in ("1", "2"):
        config = {"source": {"source_table_type": "path", "path": f"{root}/{part}"},
                  "targets": {f"curata_{name}_{tag}": {**load, "type": kind} for name, kind in kinds.items()}}
        loader.load_targets(spark, config, f"{root}/tables")
    out = None
    for name in kinds:
        t = spark.table(f"curata_{name}_{tag}")
        cur = F.col("is_current") if name == "compared" else F.lit(1)
        one = t.select(F.lit(name).alias("load"), "o_orderkey", "o_totalprice", cur.alias("is_current"))
        out = one if out is None else out.unionByName(one)
    return out


@query("pipe_load_state", f"""
SELECT * EXCLUDE (rn), 3 AS loads, (SELECT strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem) AS watermark
FROM (SELECT *, row_number() OVER ({LI_W_DESC}) rn FROM lineitem) WHERE rn = 1""")
def pipe_load_state(spark, d):
    """An initial load, two deltas, a load that fails and one that finds nothing: flag,
    watermark and content always advance together."""
    root = scratch_path(spark, "pipe-state")
    li, mid = table(spark, d, "lineitem"), "2000-01-01 00:00:00"
    li.where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")).write.parquet(f"{root}/initial")
    li.write.parquet(f"{root}/delta")                      # holds old changes too: the watermark leaves them out
    config = {"source": {"source_table_type": "path", "initial_filepath": f"{root}/initial", "delta_filepath": f"{root}/delta"},
              "change_col": "l_shipdate", "load": {"type": "update", "keys": LI_KEYS, "order": LI_ORDER, "ties": LI_TIES}}
    state.run(spark, config, f"{root}/load")
    failing = {**config, "steps": [{"op": "where", "expr": "raise_error('source broke') IS NULL"}]}
    try:
        state.run(spark, failing, f"{root}/load", until=mid)
    except Exception as e:  # noqa: BLE001
        if "source broke" not in str(e):
            raise
    state.run(spark, config, f"{root}/load", until=mid)    # reads what the failed load read
    state.run(spark, config, f"{root}/load")
    last = state.run(spark, config, f"{root}/load")        # nothing new: the state stays
    out = state.table(spark, last)
    return out.withColumns({"loads": F.lit(last.number), "watermark": F.lit(last.watermark)})


@query("pipe_stream_merge", """
SELECT *, ts AS start_time, 0 AS is_deleted, lead(ts) OVER w AS end_time, CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def pipe_stream_merge(spark, d):
    """A configured streaming source with a type-2 load, over three micro-batches."""
    root = scratch_path(spark, "pipe-stream")
    config = {"source": {"streaming": True, "format": "parquet", "path": f"{root}/landing"},
              "load": {"type": "scd2", "keys": ["user_id"], "order": ["ts"], "ties": ["event_id"]}}
    out = None
    for _ in _waves(spark, d, root):
        out = loader.run_stream_load(spark, config, f"{root}/out", f"{root}/_checkpoint")
    return out


# -------------------------------------------------------------- rule catalogs
CATALOG_REL = [
    (21, 1, "orders", "o_orderstatus", None, None, None, None, "flag", None, None),
    (22, 2, "orders", "o_totalprice", "between", 1000.0, 450000.0, None, "flag", None, None),
    (23, 3, "orders", "o_custkey", None, None, None, None, "flag", "customer", None),
    (24, 4, "orders", "o_custkey", None, None, None, None, "flag", None, "o_custkey, o_orderstatus"),
    (25, 5, "orders", "o_totalprice", None, None, None, None, "flag", None, None),
    (26, 6, "orders", "o_orderpriority", None, None, None, None, "flag", None, None),
    (27, 7, "orders", "o_orderdate_text", None, None, None, None, "flag", None, None),
    (28, 8, "orders", "o_orderpriority", None, 8.0, None, None, "flag", None, None),
    (29, 9, "orders", "o_orderpriority", None, None, None, 3, "flag", None, None),
    (30, 9, "orders", "o_orderstatus", None, None, None, 1, "immediate", None, None),
]
CATALOG_REL_SCHEMA = ("rule_object_rel_id int, rule_dim_id int, table_name string, column_name string, operator string, "
                      "threshold_low double, threshold_high double, valid_list_id int, implement_type string, "
                      "related_table_name string, grouping_columns string")
CATALOG_DIM = [(1, "null_check", None, None, None, None, "Y"), (2, "range_check", None, None, None, None, "Y"),
               (3, "orphan_check", None, None, None, "c_custkey", "Y"), (4, "unique_check", None, None, None, None, "Y"),
               (5, "datatype_check", None, "double", None, None, "Y"), (6, "special_character_check", "[#@]", None, None, None, "Y"),
               (7, "date_format_check", None, None, "yyyy-MM-dd", None, "Y"), (8, "fixed_length_check", None, None, None, None, "Y"),
               (9, "valid_values_check", None, None, None, None, "Y")]
CATALOG_DIM_SCHEMA = ("rule_dim_id int, rule_type_desc string, regex_string string, expected_datatype string, "
                      "expected_date_format string, related_column_name string, enabled string")


def catalog_rules(spark, d):
    """Rule dicts straight from the catalog tables."""
    values = _value_rows(spark, d).unionByName(spark.createDataFrame([(3, "6-LOW, LATER")], "list_id int, column_value string"))
    rows = Q.rule_catalog(spark.createDataFrame(CATALOG_REL, CATALOG_REL_SCHEMA), spark.createDataFrame(CATALOG_DIM, CATALOG_DIM_SCHEMA),
                          Q.value_lists(values), "flag").collect()
    return Q.rule_dicts(rows, values, {"customer": table(spark, d, "customer")})


CATALOG_CONDS = [
    ("21", "o_orderstatus IS NULL"), ("22", "coalesce(NOT (o_totalprice BETWEEN 1000 AND 450000), false)"),
    ("23", "NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.o_custkey)"),
    ("24", "count(*) OVER (PARTITION BY o_custkey, o_orderstatus) > 1"), ("25", "false"),
    ("26", "coalesce(regexp_matches(o_orderpriority, '[#@]'), false)"),
    ("27", "try_strptime(o_orderdate_text, '%Y-%m-%d') IS NULL AND o_orderdate_text IS NOT NULL"),
    ("28", "coalesce(length(o_orderpriority) > 8, false)"),
    ("29", "o_orderpriority IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders v WHERE v.o_orderpriority = d.o_orderpriority)"),
]


@query("dq_catalog_flags", with_("dirty_orders") + "SELECT o_orderkey, concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} THEN '{i}' END" for i, c in CATALOG_CONDS) + ") AS dq_result FROM dirty_orders d")
def dq_catalog_flags(spark, d):
    """All nine rule types, from catalog rows to flags; one listed value holds a comma."""
    out = Q.flag_rules(dirty_orders(spark, d), sorted(catalog_rules(spark, d), key=lambda r: r["id"]))
    return out.select("o_orderkey", F.array_join("data_quality_result_array", ",").alias("dq_result"))


# ------------------------------------------------------------ landing to raw
HKEY = md5_of([("l_orderkey", "str"), ("l_linenumber", "str")])


@query("landing_append", f"SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, {HKEY} AS hkey FROM lineitem")
def landing_append(spark, d):
    """Two appended batches keep every row, repeated keys included."""
    target = None
    for batch in (li_hist(spark, d).drop("start_time", "end_time", "is_current", "is_deleted"), li_new(spark, d)):
        target = flows.landing_to_raw(target, batch, LI_KEYS, LI_ORDER, LI_TIES, load_type="append")[0]
    return target.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "hkey")


@query("landing_history", with_("tgt_orders", "src_orders") + f"""
SELECT t.*, 'N' AS curr_row_flg FROM tgt_orders t JOIN src_orders s ON t.o_orderkey = s.o_orderkey WHERE {ORD_DIFF}
UNION ALL SELECT s.*, 'Y' FROM src_orders s
UNION ALL SELECT t.*, 'D' FROM tgt_orders t WHERE NOT EXISTS (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey)""")
def landing_history(spark, d):
    """A second full batch after the first: replaced rows stay as N, gone ones as D."""
    first = flows.landing_history(None, tgt_orders(spark, d), ["o_orderkey"], ["o_orderdate"])
    return flows.landing_history(first, src_orders(spark, d), ["o_orderkey"], ["o_orderdate"]).drop("hkey", "hdiff")
