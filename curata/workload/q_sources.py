"""Query keys: readers, control tables, sinks (written, then read back)."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import control, files, sinks, tables
from ..streaming.sources import decoded_name
from .inputs import AS_OF, SPLIT, table
from .registry import query

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _path(d, name):
    return f"{d.rstrip('/')}/{name}.parquet"


@query("src_parquet_lineage", f"""
SELECT *, 'orders.parquet' AS file_name, 1 AS is_current, 0 AS is_deleted,
  TIMESTAMP '{AS_OF}' AS start_time, CAST(NULL AS TIMESTAMP) AS end_time, TIMESTAMP '{AS_OF}' AS row_creation_time
FROM orders""")
def src_parquet_lineage(spark, d):
    df = files.read_parquet(spark, _path(d, "orders"), options={"mergeSchema": "false"}, as_of=AS_OF)
    return (df.withColumn("file_name", decoded_name(F.col("file_path")))
            .drop("file_path", "file_modification_time"))


@query("src_parquet_plain", f"""
SELECT *, 'lineitem.parquet' AS file_name, TIMESTAMP '{AS_OF}' AS read_creation_time, 0 AS is_deleted FROM lineitem""")
def src_parquet_plain(spark, d):
    df = files.read_parquet(spark, _path(d, "lineitem"), as_of=AS_OF)
    return (df.withColumn("file_name", decoded_name(F.col("file_path")))
            .drop("file_path", "file_modification_time"))


@query("src_parquet_file_order", f"""
SELECT CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN 'z-first' ELSE 'a-second' END AS folder, count(*) AS n, true AS in_order
FROM orders GROUP BY 1""")
def src_parquet_file_order(spark, d):
    """Files landed one after the other, read in the order they landed in (against that of
    their names): per folder its rows, and whether they all come after those of the folder before."""
    root = scratch_path(spark, "file-order")
    o = table(spark, d, "orders")
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    o.where(early).write.parquet(f"{root}/z-first")
    time.sleep(1.1)                                       # file times count whole seconds on some stores
    o.where(~early).write.parquet(f"{root}/a-second")
    df = files.read_parquet(spark, root, options={"recursiveFileLookup": "true"}, as_of=AS_OF, order_by_file_time=True)
    df = df.select(F.element_at(F.split("file_path", "/"), -2).alias("folder"), "file_modification_time", F.monotonically_increasing_id().alias("at"))
    per = df.groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high"),
                                   F.min("file_modification_time").alias("landed"))
    before = F.lag("high").over(Window.orderBy("landed"))                      # one row per landing folder
    return per.select("folder", "n", F.coalesce(F.col("low") > before, F.lit(True)).alias("in_order"))


def _roundtrip(spark, d, fmt, options=None):
    cust = table(spark, d, "customer")
    path = scratch_path(spark, f"customer-{fmt}")
    sinks.overwrite_write(cust, fmt, path=path, options=options)
    return path, cust.schema


@query("src_csv", "SELECT * FROM customer")
def src_csv(spark, d):
    path, schema = _roundtrip(spark, d, "csv", {"header": "true"})
    return files.read_csv(spark, path, {"header": "true"}, schema=schema)


@query("src_json", "SELECT * FROM customer")
def src_json(spark, d):
    path, schema = _roundtrip(spark, d, "json")
    return files.read_json(spark, path, schema=schema)


@query("src_orc", "SELECT * FROM customer")
def src_orc(spark, d):
    path, _ = _roundtrip(spark, d, "orc")
    return files.read_orc(spark, path)


@query("src_format_path", "SELECT * FROM customer")
def src_format_path(spark, d):
    path, _ = _roundtrip(spark, d, "parquet")
    return files.read_format_path(spark, path, fmt="parquet")


@query("src_table", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def src_table(spark, d):
    """Two-level name (default database filled in) and three-level name."""
    path = scratch_path(spark, "customer-table")
    name = "curata_customer_" + path.rsplit("-", 1)[-1]
    sinks.overwrite_write(table(spark, d, "customer"), "parquet", table=name, options={"path": path})
    return tables.read_table(spark, name).unionByName(tables.read_three_level(spark, f"spark_catalog.default.{name}"))


def _split_orders(spark, d):
    """Land orders as an initial folder (before the split date) and a delta
    folder (from the split date), the way a landing zone receives them."""
    o = table(spark, d, "orders")
    root = scratch_path(spark, "orders-landing")
    sinks.overwrite_write(o.where(F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")).drop("o_orderpriority"),
                          path=f"{root}/initial")
    sinks.overwrite_write(o.where(F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp_ntz")), path=f"{root}/delta")
    return root


@query("src_initial_or_delta", f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}'")
def src_initial_or_delta(spark, d):
    root = _split_orders(spark, d)
    ctl = spark.createDataFrame(
        [("sales", "orders", f"{root}/initial", f"{root}/delta", "true")],
        "schema_name string, table_name string, initial_filepath string, delta_filepath string, "
        "is_initial_completed string")
    row = control.control_row(ctl, "sales", "orders")
    return files.read_format_path(spark, files.initial_or_delta_path(row))


@query("src_latest_file", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def src_latest_file(spark, d):
    """The newest landed file defines the schema of the whole folder read
    (older files lack o_orderpriority and read it as null)."""
    root = _split_orders(spark, d)
    opts = {"recursiveFileLookup": "true"}
    newest = files.read_latest_file(spark, "parquet", root, opts)
    return files.read(spark, "parquet", root, opts, schema=newest.schema)


# --------------------------------------------------------------- control rows
def ctl_rows(spark, d):
    """A control table with one row per landed part feed (derived from part)."""
    p = table(spark, d, "part")
    return p.select(
        F.col("p_brand").alias("data_product_name"),
        F.concat(F.lit("s"), (F.col("p_partkey") / 500).cast("bigint").cast("string")).alias("schema_name"),
        F.concat(F.lit("tbl_"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("table_name"),
        F.lit("p_partkey").alias("pkeys"),
        F.concat(F.lit("/landing/"), F.lower("p_type"), F.lit("/"), F.col("p_partkey").cast("string")).alias("source_filepath"),
        F.when(F.col("p_size") > 25, "TRUE").otherwise("false").alias("is_table_enabled"),
    )


CTL_SQL = """WITH ctl AS (SELECT p_brand AS data_product_name,
  's' || CAST(CAST(trunc(p_partkey / 500) AS BIGINT) AS VARCHAR) AS schema_name,
  'tbl_' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS table_name, 'p_partkey' AS pkeys,
  '/landing/' || lower(p_type) || '/' || CAST(p_partkey AS VARCHAR) AS source_filepath,
  CASE WHEN p_size > 25 THEN 'TRUE' ELSE 'false' END AS is_table_enabled FROM part)
"""


@query("ctl_lookup", CTL_SQL + "SELECT * FROM ctl WHERE schema_name = 's0' AND table_name = 'tbl_000003'")
def ctl_lookup(spark, d):
    return control.lookup(ctl_rows(spark, d), "s0", "tbl_000003")


@query("ctl_worklist", CTL_SQL + "SELECT * FROM ctl WHERE upper(is_table_enabled) = 'TRUE' AND data_product_name = 'Brand#13' ORDER BY table_name")
def ctl_worklist(spark, d):
    return control.worklist(ctl_rows(spark, d), "Brand#13")


@query("ctl_cell_lookup", CTL_SQL + "SELECT source_filepath FROM ctl WHERE schema_name = 's0' AND table_name = 'tbl_000003'")
def ctl_cell_lookup(spark, d):
    return control.cell(ctl_rows(spark, d), "source_filepath", schema_name="s0", table_name="tbl_000003")


# ---------------------------------------------------------------------- sinks
@query("sink_overwrite", "SELECT * FROM orders")
def sink_overwrite(spark, d):
    o = table(spark, d, "orders")
    path = scratch_path(spark, "sink-overwrite")
    sinks.overwrite_write(o.where(F.col("o_orderstatus") == "F"), path=path)
    sinks.overwrite_write(o, path=path)
    return spark.read.parquet(path)


@query("sink_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'")
def sink_append(spark, d):
    o = table(spark, d, "orders")
    path = scratch_path(spark, "sink-append")
    sinks.overwrite_write(o, path=path)
    sinks.append_write(o.where(F.col("o_orderstatus") == "O"), path=path)
    return spark.read.parquet(path)


@query("sink_fanout", f"""
SELECT *, 'parquet' AS sink FROM orders UNION ALL SELECT *, 'orc' FROM orders
UNION ALL SELECT *, 'table' FROM orders""")
def sink_fanout(spark, d):
    o = table(spark, d, "orders")
    root = scratch_path(spark, "sink-fanout")
    name = "curata_orders_" + root.rsplit("-", 1)[-1]
    sinks.fanout(o, [
        {"mode": "overwrite", "format": "parquet", "path": f"{root}/parquet"},
        {"mode": "overwrite", "format": "orc", "path": f"{root}/orc"},
        {"mode": "overwrite", "format": "parquet", "table": name, "options": {"path": f"{root}/table"}},
    ])
    return (spark.read.parquet(f"{root}/parquet").withColumn("sink", F.lit("parquet"))
            .unionByName(spark.read.orc(f"{root}/orc").withColumn("sink", F.lit("orc")))
            .unionByName(spark.read.table(name).withColumn("sink", F.lit("table"))))
