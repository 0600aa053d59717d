"""Query keys: late-arriving members for nine fact feeds (lineitem slices)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe, late
from .inputs import AS_OF, dim_part, table, with_
from .registry import query

WINDOW = ("1995-01-01 00:00:00", "2002-01-01 00:00:00")
W_SQL = f"l_shipdate BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'"
PO_WINDOW = ("1999-01-01 00:00:00", "1999-12-31 23:59:59")
ATTRS = ["p_name", "p_brand", "p_type"]


def _sql(inc: str) -> str:
    return with_("dim_part", extra={
        "inc": inc,
        "miss": "SELECT DISTINCT k FROM inc WHERE NOT EXISTS (SELECT 1 FROM dim_part d WHERE d.p_partkey = inc.k "
                "AND inc.dt BETWEEN d.valid_from_date AND d.valid_through_date)",
    }) + f"""SELECT md5('late_' || CAST(k AS VARCHAR)) AS part_dim_id, 'erp' AS source_system, k AS p_partkey,
  'NA' AS p_name, 'NA' AS p_brand, 'NA' AS p_type, TIMESTAMP '1900-01-01 00:00:00' AS valid_from_date,
  TIMESTAMP '9999-12-31 00:00:00' AS valid_through_date, TIMESTAMP '{AS_OF}' AS create_date FROM miss"""


def _late(spark, d, fact, key="l_partkey", date="l_shipdate", window=WINDOW, change_col=None):
    return late.late_members(fact, dim_part(spark, d), key, date, "p_partkey", AS_OF, ATTRS,
                             id_col="part_dim_id", fixed={"source_system": "erp"}, window=window,
                             change_col=change_col)


def _slice(cond_sql):
    return _sql(f"SELECT l_partkey AS k, l_shipdate AS dt FROM lineitem WHERE ({cond_sql}) AND {W_SQL}")


@query("late_dc_items", _slice("true"))
def late_dc_items(spark, d):
    return _late(spark, d, table(spark, d, "lineitem"))


@query("late_omni_sales", _slice("l_linestatus = 'O'"))
def late_omni_sales(spark, d):
    return _late(spark, d, table(spark, d, "lineitem").where("l_linestatus = 'O'"))


@query("late_order_forecast", _slice("l_returnflag = 'N'"))
def late_order_forecast(spark, d):
    return _late(spark, d, table(spark, d, "lineitem").where("l_returnflag = 'N'"))


@query("late_store_returns", _slice("l_returnflag = 'R'"))
def late_store_returns(spark, d):
    return _late(spark, d, table(spark, d, "lineitem").where("l_returnflag = 'R'"))


@query("late_store_sales", _slice("l_linestatus = 'F'"))
def late_store_sales(spark, d):
    return _late(spark, d, table(spark, d, "lineitem").where("l_linestatus = 'F'"))


@query("late_ecom_items", _sql(f"""SELECT coalesce(m.mk, l.l_partkey) AS k, l.l_shipdate AS dt FROM lineitem l
LEFT JOIN (SELECT l_suppkey AS lv, l_partkey AS mk FROM (SELECT *, row_number() OVER
  (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_partkey DESC) AS rn FROM lineitem WHERE l_returnflag = 'R')
  WHERE rn = 1) m ON l.l_suppkey = m.lv WHERE {W_SQL}"""))
def late_ecom_items(spark, d):
    li = table(spark, d, "lineitem")
    lookup = dedupe.latest_per_key(li.where("l_returnflag = 'R'"), ["l_suppkey"], ["l_shipdate"], ["l_partkey"])
    fact = late.fallback_key(li, lookup, "l_suppkey", "l_suppkey", "l_partkey", "l_partkey", "mapped_key")
    return _late(spark, d, fact, key="mapped_key")


@query("late_purchase_order", _sql(f"""SELECT l.l_partkey AS k, l.l_shipdate AS dt FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate BETWEEN TIMESTAMP '{PO_WINDOW[0]}' AND TIMESTAMP '{PO_WINDOW[1]}'
   OR o.o_orderdate BETWEEN TIMESTAMP '{PO_WINDOW[0]}' AND TIMESTAMP '{PO_WINDOW[1]}'"""))
def late_purchase_order(spark, d):
    li = table(spark, d, "lineitem")
    hdr = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(hdr, li["l_orderkey"] == hdr["o_orderkey"], "left")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in PO_WINDOW)
    inc = j.where(F.col("l_shipdate").between(lo, hi) | F.col("o_orderdate").between(lo, hi))
    return _late(spark, d, inc, window=None)


@query("late_demand_forecast", _sql("""SELECT f.k, c.day AS dt FROM
  (SELECT DISTINCT l_partkey AS k, date_trunc('week', l_shipdate) AS wk FROM lineitem) f
  JOIN (SELECT DISTINCT date_trunc('week', o_orderdate) AS wk, date_trunc('day', o_orderdate) AS day FROM orders) c
  ON f.wk = c.wk"""))
def late_demand_forecast(spark, d):
    fact = (table(spark, d, "lineitem")
            .select("l_partkey", F.date_trunc("week", "l_shipdate").alias("wk")).distinct())
    cal = table(spark, d, "orders").select(F.date_trunc("week", "o_orderdate").alias("wk"),
                                           F.date_trunc("day", "o_orderdate").alias("day"))
    days = late.expand_calendar(fact, cal, "wk", "wk", "day")
    return _late(spark, d, days, date="day", window=None)


@query("late_store_union", _sql(f"""SELECT l_partkey AS k, l_shipdate AS dt FROM lineitem WHERE l_linestatus = 'O'
UNION SELECT l_partkey, l_shipdate FROM lineitem WHERE l_returnflag = 'N'
UNION SELECT l_partkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R'
UNION SELECT l_partkey, l_shipdate FROM lineitem WHERE l_linestatus = 'F'"""))
def late_store_union(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_linestatus", "l_returnflag")
    parts = [li.where("l_linestatus = 'O'"), li.where("l_returnflag = 'N'"),
             li.where("l_returnflag = 'R'"), li.where("l_linestatus = 'F'")]
    u = parts[0].select("l_partkey", "l_shipdate")
    for p in parts[1:]:
        u = u.union(p.select("l_partkey", "l_shipdate"))
    return _late(spark, d, u.distinct(), window=None)
