"""Query keys: declared steps, mapped projections, the end-to-end load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental, scd
from ..plans import loader, steps
from ..sources import control
from .inputs import AS_OF, SPLIT, dirty_orders, table, with_
from .registry import comparable, query

CONTROL = ["file_modification_time", "file_path", "is_current", "is_deleted", "start_time", "end_time",
           "row_creation_time"]


def _run(df, chain, registry=None):
    out, _ = steps.run(df, chain, registry)
    return out


@query("step_where", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def step_where(spark, d):
    return _run(table(spark, d, "orders"), [{"op": "where", "expr": "o_orderstatus = 'F' AND o_totalprice > 100000"}])


@query("step_select", """
SELECT o_orderkey, o_totalprice * 2 AS double_price, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""")
def step_select(spark, d):
    return _run(table(spark, d, "orders"), [{"op": "select", "columns": [
        "o_orderkey", "o_totalprice * 2 AS double_price", "year(o_orderdate) AS order_year"]}])


@query("step_drop", "SELECT * EXCLUDE (o_orderpriority) FROM orders")
def step_drop(spark, d):
    return _run(table(spark, d, "orders"), [{"op": "drop", "columns": ["o_orderpriority", "o_comment"]}])


@query("step_rename", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, * EXCLUDE (o_orderkey, o_custkey) FROM orders")
def step_rename(spark, d):
    return _run(table(spark, d, "orders"), [{"op": "rename", "mapping": {"o_orderkey": "order_id", "o_custkey": "customer_id"}}])


@query("step_normalize", """
SELECT c_custkey, c_name, c_nationkey AS c_nation_key, c_acctbal, c_mktsegment AS c_mkt_segment FROM customer""")
def step_normalize(spark, d):
    raw = table(spark, d, "customer").toDF("c custkey", "c/name", "c nation key", "c_acctbal", "c mkt/segment")
    return _run(raw, [{"op": "normalize"}])


@query("step_positional_names", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer""")
def step_positional_names(spark, d):
    return _run(table(spark, d, "customer"), [{"op": "positional", "names": ["id", "name", "nation", "balance", "segment"]}])


@query("step_fillna", with_("dirty_orders") + """
SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, 'na') AS o_orderstatus, o_totalprice, o_orderdate,
  coalesce(o_orderpriority, 'na') AS o_orderpriority, coalesce(o_orderdate_text, 'na') AS o_orderdate_text,
  coalesce(o_totalprice_text, 'na') AS o_totalprice_text FROM dirty_orders""")
def step_fillna(spark, d):
    return _run(dirty_orders(spark, d), [{"op": "fillna", "value": "na"}])


@query("step_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def step_distinct(spark, d):
    return _run(table(spark, d, "lineitem"), [{"op": "select", "columns": ["l_orderkey", "l_linenumber"]},
                                              {"op": "distinct"}])


@query("step_cast", """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(13,3)) AS DOUBLE) AS o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM orders""")
def step_cast(spark, d):
    out = _run(table(spark, d, "orders"), [{"op": "cast", "types": {
        "o_custkey": "int", "o_totalprice": "decimal(13,3)", "o_orderdate": "date"}}])
    return comparable(out, decimals=["o_totalprice"], dates=["o_orderdate"])


@query("step_timestamps", f"""
SELECT *, TIMESTAMP '{AS_OF}' AS create_date, TIMESTAMP '{AS_OF}' AS change_date, TIMESTAMP '{AS_OF}' AS src_file_process_time,
  '' AS hkey, '' AS hdiff, CAST(NULL AS TIMESTAMP) AS file_modification_time FROM customer""")
def step_timestamps(spark, d):
    return _run(table(spark, d, "customer"), [{"op": "timestamps", "as_of": AS_OF}])


def net_price(df, rate: float = 0.0):
    """Example registered step: discounted price with a surcharge rate."""
    return df.withColumn("l_net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + rate))


@query("step_py", "SELECT *, l_extendedprice * (1 - l_discount) * (1 + 0.5) AS l_net_price FROM lineitem")
def step_py(spark, d):
    return _run(table(spark, d, "lineitem"), [{"op": "py", "name": "net_price", "args": {"rate": 0.5}}],
                {"net_price": net_price})


@query("step_sql", """
SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS max_price FROM orders WHERE o_totalprice > 1000
GROUP BY o_orderstatus""")
def step_sql(spark, d):
    return _run(table(spark, d, "orders"), [{"op": "sql", "text":
        "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS max_price FROM {table_view} "
        "WHERE o_totalprice > {low} GROUP BY o_orderstatus", "params": {"low": 1000}}])


@query("step_observe_count", "SELECT * FROM orders")
def step_observe_count(spark, d):
    df, _obs = steps.observe_count(table(spark, d, "orders"))
    return df


# ------------------------------------------------------------ column mappings
def map_rows(spark):
    """Column-mapping control rows for the customer table."""
    return spark.createDataFrame([
        ("crm", "customer", "c_custkey", "customer_id", None, 1, 1),
        ("crm", "customer", "c_name", "customer_name", "upper(c_name)", 2, None),
        ("crm", "customer", "c_acctbal", "balance", None, 3, None),
        ("crm", "customer", "c_mktsegment", "segment", "lower(c_mktsegment)", 4, None),
    ], "schema_name string, table_name string, source_col_name string, target_col_name string, "
       "target_col_expression string, target_col_order int, target_key_col_order int")


@query("step_rename_mapped", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS balance, c_mktsegment AS segment
FROM customer""")
def step_rename_mapped(spark, d):
    rows = control.mapping_rows(map_rows(spark), "customer")
    return _run(table(spark, d, "customer"), [{"op": "rename", "mapping": control.rename_map(rows)}])


MAP_SRC = ("SELECT c_custkey AS customer_id, upper(c_name) AS customer_name, c_acctbal AS balance, "
           "lower(c_mktsegment) AS segment FROM customer")


@query("map_projection", MAP_SRC)
def map_projection(spark, d):
    return control.mapped_projection(table(spark, d, "customer"), map_rows(spark), "customer")


@query("map_merge", with_(extra={
    "src": MAP_SRC,
    "tgt": "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance, c_mktsegment AS segment, "
           "'old' AS load_note FROM customer WHERE c_nationkey < 12",
}) + """
SELECT t.customer_id, s.customer_name, s.balance, s.segment, t.load_note FROM tgt t JOIN src s ON t.customer_id = s.customer_id
UNION ALL SELECT s.*, CAST(NULL AS VARCHAR) AS load_note FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.customer_id = s.customer_id)
UNION ALL SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE t.customer_id = s.customer_id)""")
def map_merge(spark, d):
    cust = table(spark, d, "customer")
    rows = control.mapping_rows(map_rows(spark), "customer")
    keys, update, insert = control.merge_lists(rows)
    src = cust.selectExpr(*control.projection_exprs(rows))
    tgt = cust.where("c_nationkey < 12").selectExpr(
        "c_custkey AS customer_id", "c_name AS customer_name", "c_acctbal AS balance", "c_mktsegment AS segment",
        "'old' AS load_note")
    return scd.scd1(tgt, src, keys, update=update, insert=insert)


# ------------------------------------------------------------- end-to-end load
def _pipe_config(d, date_filter):
    return {
        "source": {"source_table_type": "parquet", "path": f"{d.rstrip('/')}/orders.parquet",
                   "options": {"mergeSchema": "false"}, "as_of": AS_OF},
        "steps": [
            {"op": "where", "expr": f"o_orderstatus <> 'P' AND {date_filter}"},
            {"op": "cast", "types": {"o_totalprice": "decimal(13,3)"}},
            {"op": "rename", "mapping": {"o_custkey": "customer_id"}},
            {"op": "drop", "columns": CONTROL},
        ],
    }


PIPE_B = ("SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, "
          "CAST(CAST(o_totalprice AS DECIMAL(13,3)) AS DOUBLE) AS o_totalprice, "
          "o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'")
PIPE_W = "PARTITION BY customer_id ORDER BY o_orderdate DESC, o_orderkey DESC"


@query("pipe_end_to_end", with_(extra={
    "b": PIPE_B,
    "t": f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({PIPE_W}) rn FROM b "
         f"WHERE o_orderdate < TIMESTAMP '{SPLIT}') WHERE rn = 1",
    "n": f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({PIPE_W}) rn FROM b "
         f"WHERE o_orderdate >= TIMESTAMP '{SPLIT}') WHERE rn = 1",
}) + "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.customer_id = t.customer_id) UNION ALL SELECT * FROM n")
def pipe_end_to_end(spark, d):
    load = {"keys": ["customer_id"], "order": ["o_orderdate"], "ties": ["o_orderkey"]}
    first = _pipe_config(d, f"o_orderdate < '{SPLIT}'")
    first["load"] = {**load, "type": "complete"}
    target = loader.run_load(spark, first)
    second = _pipe_config(d, f"o_orderdate >= '{SPLIT}'")
    second["load"] = {**load, "type": "update"}
    return comparable(loader.run_load(spark, second, target=target), decimals=["o_totalprice"])


@query("incr_window", """
SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'
UNION ALL SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'""")
def incr_window(spark, d):
    o = table(spark, d, "orders")
    closed = incremental.window(o, "o_orderdate", "1996-01-01 00:00:00", "1996-12-31 23:59:59")
    open_end = incremental.window(o, "o_orderdate", "2001-01-01 00:00:00")
    return closed.unionByName(open_end)


@query("incr_watermark", """
SELECT 'orders_stream' AS stream_name, 'sales' AS schema_name, 'orders' AS table_name, 'curated_load' AS job_name,
  'batch' AS manual_or_batch_load_flag, max(o_orderdate) AS change_date
FROM orders WHERE o_orderdate > TIMESTAMP '1999-12-31 00:00:00'""")
def incr_watermark(spark, d):
    inc = incremental.window(table(spark, d, "orders"), "o_orderdate", "1999-12-31 00:00:00")
    return incremental.watermark_row(inc, "o_orderdate", {
        "stream_name": "orders_stream", "schema_name": "sales", "table_name": "orders",
        "job_name": "curated_load", "manual_or_batch_load_flag": "batch"})
