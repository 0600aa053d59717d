"""Query keys: dimension staging and apply, staged loads, detail collapse."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims
from .inputs import AS_OF, dim_part, src_part, table, with_
from .registry import query

KEYS = ["p_partkey"]
TRACKED = ["p_retailprice"]
ATTRS = ["p_name", "p_brand", "p_type", "p_size"]
OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
MIN = "TIMESTAMP '1900-01-01 00:00:00'"
T = f"TIMESTAMP '{AS_OF}'"
BASE = with_("dim_part", "src_part", extra={
    "opn": f"SELECT * FROM dim_part WHERE valid_through_date = {OPEN}",
    "chg": "SELECT s.* FROM src_part s JOIN opn o ON s.p_partkey = o.p_partkey "
           "WHERE s.p_retailprice IS DISTINCT FROM o.p_retailprice",
    "stg": "SELECT CAST(p_partkey AS VARCHAR) AS merge_key, *, 'close' AS stage FROM chg "
           "UNION ALL SELECT NULL, *, 'insert' FROM chg "
           "UNION ALL SELECT NULL, s.*, 'new' FROM src_part s WHERE NOT EXISTS "
           "(SELECT 1 FROM dim_part o WHERE o.p_partkey = s.p_partkey)",
    "ended": f"SELECT p_partkey, max(valid_through_date) AS t FROM dim_part WHERE valid_through_date <> {OPEN} GROUP BY p_partkey",
})


def _staging(spark, d):
    return dims.scd2_staging(src_part(spark, d), dim_part(spark, d), KEYS, TRACKED)


@query("dim_scd2_staging", BASE + "SELECT * FROM stg")
def dim_scd2_staging(spark, d):
    return _staging(spark, d)


@query("dim_scd2_apply", BASE + f"""
SELECT * FROM dim_part WHERE valid_through_date <> {OPEN}
UNION ALL BY NAME
SELECT o.* REPLACE (CASE WHEN c.k IS NOT NULL THEN {T} - INTERVAL 1 SECOND ELSE o.valid_through_date END AS valid_through_date)
FROM opn o LEFT JOIN (SELECT DISTINCT merge_key AS k FROM stg WHERE stage = 'close') c ON CAST(o.p_partkey AS VARCHAR) = c.k
UNION ALL BY NAME
SELECT md5('v2_' || CAST(p_partkey AS VARCHAR) || '_{AS_OF}') AS part_dim_id, 'erp' AS source_system,
  p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
  CASE WHEN stage = 'new' THEN {MIN} ELSE {T} END AS valid_from_date, {OPEN} AS valid_through_date
FROM stg WHERE stage IN ('insert', 'new')""")
def dim_scd2_apply(spark, d):
    return dims.scd2_apply(dim_part(spark, d), _staging(spark, d), KEYS, AS_OF, "part_dim_id", "v2_",
                           fixed={"source_system": "erp"})


HIT = "s.p_partkey IS NOT NULL AND NOT (o.p_retailprice IS DISTINCT FROM s.p_retailprice)"


@query("dim_scd1_apply", BASE + f"""
SELECT * FROM dim_part WHERE valid_through_date <> {OPEN}
UNION ALL BY NAME
SELECT o.* REPLACE ({', '.join(f'CASE WHEN {HIT} THEN coalesce(s.{c}, o.{c}) ELSE o.{c} END AS {c}' for c in ATTRS)})
FROM opn o LEFT JOIN src_part s ON o.p_partkey = s.p_partkey""")
def dim_scd1_apply(spark, d):
    return dims.scd1_apply(dim_part(spark, d), src_part(spark, d), KEYS, TRACKED, ATTRS)


@query("dim_new_members", BASE + "SELECT * FROM src_part s WHERE NOT EXISTS (SELECT 1 FROM dim_part o WHERE o.p_partkey = s.p_partkey)")
def dim_new_members(spark, d):
    return dims.new_members(src_part(spark, d), dim_part(spark, d), KEYS)


NEW_ID = f"md5('part_' || CAST(s.p_partkey AS VARCHAR) || '_{AS_OF}')"
STAGED = BASE[:-1] + f""",
staged AS (
SELECT o.* REPLACE ({T} - INTERVAL 1 MILLISECOND AS valid_through_date), 'U2' AS load_type
FROM opn o JOIN src_part s ON o.p_partkey = s.p_partkey WHERE o.p_retailprice IS DISTINCT FROM s.p_retailprice
UNION ALL BY NAME
SELECT {NEW_ID} AS part_dim_id, 'erp' AS source_system, s.*, {T} AS valid_from_date, {OPEN} AS valid_through_date, 'N2' AS load_type
FROM opn o JOIN src_part s ON o.p_partkey = s.p_partkey WHERE o.p_retailprice IS DISTINCT FROM s.p_retailprice
UNION ALL BY NAME
SELECT {NEW_ID} AS part_dim_id, 'erp' AS source_system, s.*,
  coalesce((SELECT t FROM ended e WHERE e.p_partkey = s.p_partkey), {MIN}) AS valid_from_date, {OPEN} AS valid_through_date, 'N' AS load_type
FROM src_part s WHERE NOT EXISTS (SELECT 1 FROM opn o WHERE o.p_partkey = s.p_partkey)
UNION ALL BY NAME
SELECT o.part_dim_id, o.source_system, s.*, o.valid_from_date, o.valid_through_date, 'U1' AS load_type
FROM opn o JOIN src_part s ON o.p_partkey = s.p_partkey WHERE NOT (o.p_retailprice IS DISTINCT FROM s.p_retailprice))
"""


def _staged(spark, d):
    return dims.staged_load(src_part(spark, d), dim_part(spark, d), KEYS, TRACKED, AS_OF, "part_dim_id", "part_",
                            fixed={"source_system": "erp"})


@query("dim_staged_load", STAGED + "SELECT * FROM staged")
def dim_staged_load(spark, d):
    return _staged(spark, d)


@query("dim_staged_merge", STAGED + """
SELECT * FROM dim_part d WHERE NOT EXISTS
  (SELECT 1 FROM staged s WHERE s.part_dim_id = d.part_dim_id AND s.source_system = d.source_system)
UNION ALL BY NAME SELECT * EXCLUDE (load_type) FROM staged""")
def dim_staged_merge(spark, d):
    return dims.staged_merge(dim_part(spark, d), _staged(spark, d), ["part_dim_id", "source_system"])


COLLAPSE = ["l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dim_collapse", f"""
SELECT l_partkey, {', '.join(f'max({c}) AS {c}' for c in COLLAPSE)}, count(*) AS n_rows FROM lineitem GROUP BY l_partkey""")
def dim_collapse(spark, d):
    return dims.collapse_max(table(spark, d, "lineitem"), ["l_partkey"], COLLAPSE)


@query("dim_collapse_json", """
SELECT l_partkey, CAST(to_json(list(struct_pack(l_returnflag := l_returnflag, l_linestatus := l_linestatus, n := n)
  ORDER BY l_returnflag, l_linestatus, n)) AS VARCHAR) AS detail_json
FROM (SELECT l_partkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_partkey""")
def dim_collapse_json(spark, d):
    return dims.collapse_json(table(spark, d, "lineitem"), ["l_partkey"], ["l_returnflag", "l_linestatus"])


@query("dim_collapse_parts", """
SELECT o_orderpriority, count(*) AS entries, max(n) AS top, min(o_custkey) AS first_custkey, max(o_custkey) AS last_custkey, true AS in_bounds
FROM (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderpriority""")
def dim_collapse_parts(spark, d):
    """The customers of every order priority with their counts, in parts of at most 50 entries: five keys
    with long lists.  Read part by part: no list is whole in one row."""
    p = dims.collapse_parts(table(spark, d, "orders"), ["o_orderpriority"], ["o_custkey"], per_part=50)
    size, ends = F.size("entries"), [F.col("entries")[0]["o_custkey"], F.element_at("entries", -1)["o_custkey"]]
    p = p.select("o_orderpriority", "part", size.alias("size"), ends[0].alias("low"), ends[1].alias("high"),
                 F.array_max(F.transform("entries", lambda x: x["n"])).alias("top"))
    return p.groupBy("o_orderpriority").agg(F.sum("size").alias("entries"), F.max("top").alias("top"), F.min_by("low", "part").alias("first_custkey"),
                                            F.max_by("high", "part").alias("last_custkey"), F.max(F.col("size") <= 50).alias("in_bounds"))
