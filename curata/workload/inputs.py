"""Derived inputs shared by the query keys.

Each input exists twice with the same meaning: a Spark builder and a DuckDB
CTE.  The modulo rules below do not sample anything: they derive a *changed*
source and an *older* target from the same whole table (which keys exist on
each side, which values changed).  Every row is on at least one side (the
target has the order keys not divisible by 5, the source those divisible by 3
or 5), so every query reads and processes whole tables.

Fixed values:
  AS_OF    = 2002-01-01 00:00:00   load time used instead of the clock
  OPEN_END = 9999-12-31            MIN_DATE = 1900-01-01
  li key   = (l_orderkey, l_linenumber); version order l_shipdate, l_partkey, l_suppkey
  history split date = 1998-01-01
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import ts

AS_OF = "2002-01-01 00:00:00"
SPLIT = "1998-01-01 00:00:00"
LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_shipdate"]
LI_TIES = ["l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- orders side
def tgt_orders(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderkey") % 5 != 0)


def src_orders(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").where((k % 3 == 0) | (k % 5 == 0))
    return o.withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")),
    })


def dirty_orders(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k,
        F.when(k % 13 == 0, F.col("o_custkey") + 100000).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(k % 17 == 0, F.concat(F.col("o_orderpriority"), F.lit("#"))).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 19 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate_text"),
        F.when(k % 23 == 0, F.lit("x12"))
         .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("o_totalprice_text"),
    )


# -------------------------------------------------------------- lineitem side
def li_batch(spark, d):
    return table(spark, d, "lineitem")


def li_hist(spark, d):
    """Rows before the split date as an SCD-2 history table."""
    w = Window.partitionBy(*LI_KEYS).orderBy(*LI_ORDER, *LI_TIES)
    nxt = F.lead("l_shipdate").over(w)
    return (li_batch(spark, d).where(F.col("l_shipdate") < ts(SPLIT))
            .withColumns({"start_time": F.col("l_shipdate"), "end_time": nxt,
                          "is_current": F.when(nxt.isNull(), 1).otherwise(0), "is_deleted": F.lit(0)}))


def li_new(spark, d):
    return li_batch(spark, d).where(F.col("l_shipdate") >= ts(SPLIT))


# ------------------------------------------------------------------ part side
def dim_part(spark, d):
    p = table(spark, d, "part").where(F.col("p_partkey") % 10 != 0)
    return p.select(
        F.md5(F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))).alias("part_dim_id"),
        F.lit("erp").alias("source_system"),
        *p.columns,
        ts("1900-01-01 00:00:00").alias("valid_from_date"),
        F.when(F.col("p_partkey") % 7 == 0, ts(SPLIT)).otherwise(ts("9999-12-31 00:00:00")).alias("valid_through_date"),
    )


def src_part(spark, d):
    p = table(spark, d, "part")
    return p.withColumns({
        "p_retailprice": F.when(F.col("p_partkey") % 4 == 0, F.col("p_retailprice") * 1.1).otherwise(F.col("p_retailprice")),
        "p_name": F.when(F.col("p_partkey") % 6 == 0, F.upper("p_name")).otherwise(F.col("p_name")),
    })


# ---------------------------------------------------------------- events side
def cdc_events(spark, d):
    e = table(spark, d, "events")
    return e.withColumn("op", F.when(F.col("event_type") == "signup", "insert")
                        .when(F.col("event_type") == "error", "delete").otherwise("update"))


# ------------------------------------------------------------------ DuckDB CTEs
CTE = {
    "tgt_orders": "SELECT * FROM orders WHERE o_orderkey % 5 <> 0",
    "src_orders": """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
        o_orderdate,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0""",
    "dirty_orders": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 100000 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        o_totalprice, o_orderdate,
        CASE WHEN o_orderkey % 17 = 0 THEN o_orderpriority || '#' ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 19 = 0 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate_text,
        CASE WHEN o_orderkey % 23 = 0 THEN 'x12' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS o_totalprice_text
        FROM orders""",
    "li_batch": "SELECT * FROM lineitem",
    "li_hist": """SELECT *, l_shipdate AS start_time,
        lead(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS end_time,
        CASE WHEN lead(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) IS NULL THEN 1 ELSE 0 END AS is_current,
        0 AS is_deleted
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'""",
    "li_new": "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'",
    "dim_part": """SELECT md5('part_' || CAST(p_partkey AS VARCHAR)) AS part_dim_id, 'erp' AS source_system, *,
        TIMESTAMP '1900-01-01 00:00:00' AS valid_from_date,
        CASE WHEN p_partkey % 7 = 0 THEN TIMESTAMP '1998-01-01 00:00:00' ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_through_date
        FROM part WHERE p_partkey % 10 <> 0""",
    "src_part": """SELECT p_partkey,
        CASE WHEN p_partkey % 6 = 0 THEN upper(p_name) ELSE p_name END AS p_name,
        p_brand, p_type, p_size,
        CASE WHEN p_partkey % 4 = 0 THEN p_retailprice * 1.1 ELSE p_retailprice END AS p_retailprice
        FROM part""",
    "cdc_events": """SELECT *, CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete'
        ELSE 'update' END AS op FROM events""",
}


def with_(*names: str, extra: dict | None = None) -> str:
    """A WITH clause defining the named inputs (and ``extra`` CTEs after them)."""
    parts = [f"{n} AS ({CTE[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
