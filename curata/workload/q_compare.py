"""Query keys: delta detection by columns and by hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import compare
from .inputs import src_orders, table, tgt_orders, with_
from .registry import query
from .sqlgen import distinct_any, md5_of

KEYS = ["o_orderkey"]
VALS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORD_KINDS = [("o_custkey", "str"), ("o_orderstatus", "str"), ("o_totalprice", "double"),
             ("o_orderdate", "str"), ("o_orderpriority", "str")]
BASE = with_("tgt_orders", "src_orders")


@query("cmp_full_outer", BASE + f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  {', '.join(f's.{c}' for c in VALS)}, {', '.join(f't.{c} AS {c}_target' for c in VALS)}
FROM src_orders s FULL JOIN tgt_orders t ON s.o_orderkey = t.o_orderkey
WHERE {distinct_any(VALS)}""")
def cmp_full_outer(spark, d):
    return compare.diff_rows(src_orders(spark, d), tgt_orders(spark, d), KEYS)


@query("cmp_classify", BASE + f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  {', '.join(f'CASE WHEN s.o_orderkey IS NULL THEN t.{c} ELSE s.{c} END AS {c}' for c in VALS)},
  CASE WHEN t.o_orderkey IS NULL THEN 'NEW' WHEN s.o_orderkey IS NULL THEN 'DELETED'
       WHEN {distinct_any(VALS)} THEN 'UPDATED' ELSE 'SAME' END AS action
FROM src_orders s FULL JOIN tgt_orders t ON s.o_orderkey = t.o_orderkey""")
def cmp_classify(spark, d):
    return compare.classify(src_orders(spark, d), tgt_orders(spark, d), KEYS)


@query("cmp_semi_keys", BASE + """
SELECT * FROM tgt_orders t WHERE EXISTS
  (SELECT 1 FROM src_orders s WHERE s.o_orderkey = t.o_orderkey AND s.o_custkey = t.o_custkey)""")
def cmp_semi_keys(spark, d):
    return compare.semi_keys(tgt_orders(spark, d), src_orders(spark, d), ["o_orderkey", "o_custkey"])


@query("cmp_subtract", BASE + "SELECT * FROM src_orders EXCEPT ALL SELECT * FROM tgt_orders")
def cmp_subtract(spark, d):
    return compare.subtract_rows(src_orders(spark, d), tgt_orders(spark, d))


CUST_HASH = f"""SELECT *, {md5_of([('c_custkey', 'str')])} AS hkey,
  {md5_of([('c_name', 'str'), ('c_nationkey', 'str'), ('c_acctbal', 'double'), ('c_mktsegment', 'str')], 2)} AS hdiff
FROM customer"""


@query("hash_keys", CUST_HASH)
def hash_keys(spark, d):
    return hashing.hash_keys(table(spark, d, "customer"), ["c_custkey"], scale=2)


@query("hash_row_sha2", """
SELECT *, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
  c_mktsegment)) AS row_hash FROM customer""")
def hash_row_sha2(spark, d):
    return hashing.row_sha2(table(spark, d, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


def _hashed(df):
    return hashing.hash_keys(df, KEYS)


HASHED = with_("tgt_orders", "src_orders", extra={
    "e": f"SELECT *, {md5_of([('o_orderkey', 'str')])} AS hkey, {md5_of(ORD_KINDS)} AS hdiff FROM tgt_orders",
    "i": f"SELECT *, {md5_of([('o_orderkey', 'str')])} AS hkey, {md5_of(ORD_KINDS)} AS hdiff FROM src_orders",
})


@query("hash_delta", HASHED + """
SELECT e.*, 'N' AS curr_row_flg FROM e JOIN i ON e.hkey = i.hkey WHERE e.hdiff IS DISTINCT FROM i.hdiff
UNION ALL SELECT i.*, 'Y' FROM i JOIN e ON e.hkey = i.hkey WHERE e.hdiff IS DISTINCT FROM i.hdiff
UNION ALL SELECT i.*, 'Y' FROM i WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.hkey = i.hkey)
UNION ALL SELECT e.*, 'D' FROM e WHERE NOT EXISTS (SELECT 1 FROM i WHERE e.hkey = i.hkey)
UNION ALL SELECT e.*, 'Y' FROM e JOIN i ON e.hkey = i.hkey WHERE e.hdiff IS NOT DISTINCT FROM i.hdiff""")
def hash_delta(spark, d):
    return compare.hash_delta(_hashed(tgt_orders(spark, d)), _hashed(src_orders(spark, d)))


@query("snapshot_history", HASHED + """
SELECT e.*, CASE WHEN c.hkey IS NULL THEN 'D' ELSE 'N' END AS curr_row_flg
FROM e LEFT JOIN i c ON e.hkey = c.hkey
WHERE c.hkey IS NULL OR e.hdiff IS DISTINCT FROM c.hdiff""")
def snapshot_history(spark, d):
    old = _hashed(tgt_orders(spark, d)).withColumn("curr_row_flg", F.lit("Y"))
    cur = _hashed(src_orders(spark, d)).withColumn("curr_row_flg", F.lit("Y"))
    return compare.snapshot_history(old, cur)
