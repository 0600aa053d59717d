"""Query keys: latest per key, versions, SCD type 1 and type 2 loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ts
from ..operators import dedupe, loads, scd
from .inputs import AS_OF, LI_KEYS, LI_ORDER, LI_TIES, li_batch, li_hist, li_new, src_orders, tgt_orders, table, with_
from .registry import query

LI_W_DESC = "PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC"
LI_W_ASC = "PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey"
LI_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
LI_DIFF = " OR ".join(f"o.{c} IS DISTINCT FROM s.{c}" for c in LI_VALUES)
ORD_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORD_DIFF = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in ORD_VALUES)
LI_ON = "o.l_orderkey = s.l_orderkey AND o.l_linenumber = s.l_linenumber"


def _latest_li(d):
    return dedupe.latest_per_key(d, LI_KEYS, LI_ORDER, LI_TIES)


@query("dedupe_latest", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({LI_W_DESC}) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_latest(spark, d):
    return _latest_li(li_batch(spark, d))


@query("scd2_versions", f"""
SELECT *, lead(l_shipdate) OVER ({LI_W_ASC}) AS end_time,
  CASE WHEN lead(l_shipdate) OVER ({LI_W_ASC}) IS NULL THEN 1 ELSE 0 END AS is_current,
  CAST(row_number() OVER ({LI_W_ASC}) AS INTEGER) AS version
FROM lineitem""")
def scd2_versions(spark, d):
    return dedupe.versions_per_key(li_batch(spark, d), LI_KEYS, "l_shipdate", LI_TIES)


@query("key_validity", """
SELECT count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys,
  count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
  (count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) = 0
   AND count(DISTINCT (l_orderkey, l_linenumber)) = count(*)) AS is_valid
FROM lineitem""")
def key_validity(spark, d):
    return dedupe.key_validity(table(spark, d, "lineitem"), LI_KEYS)


@query("topk_latest", """
SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5""")
def topk_latest(spark, d):
    return dedupe.top_latest(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"], 5)


SCD1_SQL = with_("tgt_orders", "src_orders") + """
SELECT * FROM tgt_orders t WHERE NOT EXISTS (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM src_orders"""


@query("scd1_merge", SCD1_SQL)
def scd1_merge(spark, d):
    return scd.scd1(tgt_orders(spark, d), src_orders(spark, d), ["o_orderkey"])


@query("load_complete", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({LI_W_DESC}) rn FROM lineitem) WHERE rn = 1""")
def load_complete(spark, d):
    """The whole batch, keys repeated, replaces what earlier loads left."""
    old = scd.current_rows(li_hist(spark, d)).drop("start_time", "end_time", "is_current", "is_deleted")
    return loads.apply_load("complete", old, li_batch(spark, d), LI_KEYS, LI_ORDER, LI_TIES)


@query("scd1_merge_latest", with_("li_hist", "li_new", extra={
    "tgt": "SELECT * EXCLUDE (start_time, end_time, is_current, is_deleted, l_tax) FROM li_hist "
           "WHERE is_current = 1 AND is_deleted = 0",
    "lat": f"SELECT * EXCLUDE (rn, l_tax), TIMESTAMP '{AS_OF}' AS load_time FROM "
           f"(SELECT *, row_number() OVER ({LI_W_DESC}) AS rn FROM li_new) WHERE rn = 1",
}) + """
SELECT *, CAST(NULL AS TIMESTAMP) AS load_time FROM tgt o
WHERE NOT EXISTS (SELECT 1 FROM lat s WHERE """ + LI_ON + """)
UNION ALL BY NAME SELECT * FROM lat""")
def scd1_merge_latest(spark, d):
    target = scd.current_rows(li_hist(spark, d))
    return scd.scd1_latest(target, li_new(spark, d), LI_KEYS, LI_ORDER, LI_TIES,
                           timestamp_col="load_time", as_of=AS_OF, except_columns=["l_tax"])


@query("scd1_first_load", f"""
SELECT * EXCLUDE (rn), TIMESTAMP '{AS_OF}' AS load_time
FROM (SELECT *, row_number() OVER ({LI_W_DESC}) AS rn FROM lineitem) WHERE rn = 1""")
def scd1_first_load(spark, d):
    return scd.scd1_latest(None, li_batch(spark, d), LI_KEYS, LI_ORDER, LI_TIES,
                           timestamp_col="load_time", as_of=AS_OF)


def _li_scd_src(df):
    return df.withColumns({"start_time": F.col("l_shipdate"), "is_deleted": F.lit(0)})


@query("scd2_first_load", f"""
SELECT *, l_shipdate AS start_time, 0 AS is_deleted,
  lead(l_shipdate) OVER ({LI_W_ASC}) AS end_time,
  CASE WHEN lead(l_shipdate) OVER ({LI_W_ASC}) IS NULL THEN 1 ELSE 0 END AS is_current
FROM lineitem""")
def scd2_first_load(spark, d):
    return scd.scd2_first_load(_li_scd_src(li_batch(spark, d)), LI_KEYS, "start_time", LI_TIES)


SCD2_MERGE_SQL = with_("li_hist", "li_new", extra={
    "src": f"SELECT * EXCLUDE (rn), l_shipdate AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, "
           f"1 AS is_current, 0 AS is_deleted FROM (SELECT *, row_number() OVER ({LI_W_DESC}) AS rn FROM li_new) WHERE rn = 1",
    "opn": "SELECT * FROM li_hist WHERE is_current = 1 AND is_deleted = 0",
    "merged": f"""SELECT * FROM li_hist WHERE NOT (is_current = 1 AND is_deleted = 0)
UNION ALL BY NAME
SELECT o.* REPLACE (CASE WHEN s.l_orderkey IS NOT NULL AND ({LI_DIFF}) THEN s.start_time ELSE o.end_time END AS end_time,
                    CASE WHEN s.l_orderkey IS NOT NULL AND ({LI_DIFF}) THEN 0 ELSE o.is_current END AS is_current)
FROM opn o LEFT JOIN src s ON {LI_ON}
UNION ALL BY NAME
SELECT s.* FROM src s LEFT JOIN opn o ON {LI_ON} WHERE o.l_orderkey IS NULL OR ({LI_DIFF})""",
})


def _scd2_merge(spark, d):
    src = _li_scd_src(_latest_li(li_new(spark, d)))
    return scd.scd2(li_hist(spark, d), src, LI_KEYS, "start_time", compare=LI_VALUES)


@query("scd2_merge", SCD2_MERGE_SQL + "SELECT * FROM merged")
def scd2_merge(spark, d):
    return _scd2_merge(spark, d)


@query("scd_current_view", SCD2_MERGE_SQL + "SELECT * FROM merged WHERE is_current = 1 AND is_deleted = 0")
def scd_current_view(spark, d):
    return scd.current_rows(_scd2_merge(spark, d))


@query("scd2_merge_versions", with_("li_hist", "li_new", extra={
    "src": "SELECT *, l_shipdate AS start_time, 0 AS is_deleted FROM li_new",
    "v": f"""SELECT *, lead(start_time) OVER w AS end_time,
        CASE WHEN lead(start_time) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
        FROM src WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY start_time, l_partkey, l_suppkey)""",
    "f": "SELECT l_orderkey, l_linenumber, min(start_time) AS first_start FROM src GROUP BY l_orderkey, l_linenumber",
}) + f"""
SELECT * FROM li_hist WHERE NOT (is_current = 1 AND is_deleted = 0)
UNION ALL BY NAME
SELECT o.* REPLACE (coalesce(s.first_start, o.end_time) AS end_time,
                    CASE WHEN s.first_start IS NOT NULL THEN 0 ELSE o.is_current END AS is_current)
FROM (SELECT * FROM li_hist WHERE is_current = 1 AND is_deleted = 0) o LEFT JOIN f s ON {LI_ON}
UNION ALL BY NAME SELECT * FROM v""")
def scd2_merge_versions(spark, d):
    return scd.scd2_versions(li_hist(spark, d), _li_scd_src(li_new(spark, d)), LI_KEYS, "start_time", LI_TIES)


@query("scd2_full_compare", with_("tgt_orders", "src_orders", extra={
    "t": "SELECT *, o_orderdate AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, 1 AS is_current, "
         "0 AS is_deleted FROM tgt_orders",
}) + f"""
SELECT t.* FROM t JOIN src_orders s ON t.o_orderkey = s.o_orderkey WHERE NOT ({ORD_DIFF})
UNION ALL BY NAME
SELECT t.* REPLACE (TIMESTAMP '{AS_OF}' AS end_time, 0 AS is_current)
FROM t JOIN src_orders s ON t.o_orderkey = s.o_orderkey WHERE {ORD_DIFF}
UNION ALL BY NAME
SELECT s.*, greatest(s.o_orderdate, TIMESTAMP '1995-01-01 00:00:00') AS start_time, CAST(NULL AS TIMESTAMP) AS end_time,
  1 AS is_current, 0 AS is_deleted
FROM src_orders s LEFT JOIN t ON t.o_orderkey = s.o_orderkey WHERE t.o_orderkey IS NULL OR ({ORD_DIFF})
UNION ALL BY NAME
SELECT t.* REPLACE (TIMESTAMP '{AS_OF}' AS end_time, 0 AS is_current, 1 AS is_deleted)
FROM t WHERE NOT EXISTS (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey)""")
def scd2_full_compare(spark, d):
    t = tgt_orders(spark, d).withColumns({
        "start_time": F.col("o_orderdate"), "end_time": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(1), "is_deleted": F.lit(0)})
    return scd.scd2_full_compare(t, src_orders(spark, d), ["o_orderkey"], ["o_orderdate", ts("1995-01-01 00:00:00")], AS_OF)
