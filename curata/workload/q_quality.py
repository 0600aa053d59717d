"""Query keys: data-quality split checks, flag rules, counts, catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import scd
from .inputs import AS_OF, dirty_orders, table, with_
from .registry import query

D = with_("dirty_orders")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIO_SQL = ", ".join(f"'{p}'" for p in PRIORITIES)
PAT = "[^a-zA-Z0-9 -]"


def _invalid(spark, d, checks):
    return Q.split(dirty_orders(spark, d), checks)[1]


def _inv_sql(reason, cond):
    return D + f"SELECT *, '{reason}' AS invalid_reason FROM dirty_orders d WHERE {cond}"


@query("dq_null", _inv_sql("null_check:o_orderstatus", "o_orderstatus IS NULL"))
def dq_null(spark, d):
    return _invalid(spark, d, [{"type": "null_check", "columns": ["o_orderstatus"]}])


RANGE_RULES = [{"type": "lower_than", "threshold": 5000}, {"type": "higher_than", "threshold": 450000},
               {"type": "invalid_range", "range": [200000, 200500]}, {"type": "valid_range", "range": [1000, 480000]},
               {"type": "mandatory"}]


@query("dq_range", _inv_sql("range_check:o_totalprice",
       "o_totalprice < 5000 OR o_totalprice > 450000 OR o_totalprice BETWEEN 200000 AND 200500 "
       "OR o_totalprice < 1000 OR o_totalprice > 480000 OR o_totalprice IS NULL"))
def dq_range(spark, d):
    return _invalid(spark, d, [{"type": "range_check", "columns": ["o_totalprice"], "rules": RANGE_RULES}])


@query("dq_orphan", _inv_sql("orphan_check:o_custkey",
       "o_custkey IS NULL OR NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.o_custkey)"))
def dq_orphan(spark, d):
    return _invalid(spark, d, [{"type": "orphan_check", "columns": ["o_custkey"],
                                "related": table(spark, d, "customer"), "related_column": "c_custkey"}])


@query("dq_unique", D + """
SELECT * EXCLUDE (rn), 'unique_check:o_custkey' AS invalid_reason FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM dirty_orders) WHERE rn > 1""")
def dq_unique(spark, d):
    return _invalid(spark, d, [{"type": "unique_check", "columns": ["o_custkey"], "order": ["o_orderkey"]}])


@query("dq_datatype", _inv_sql("datatype_check:o_totalprice_text",
       "o_totalprice_text IS NOT NULL AND TRY_CAST(o_totalprice_text AS DOUBLE) IS NULL"))
def dq_datatype(spark, d):
    return _invalid(spark, d, [{"type": "datatype_check", "columns": ["o_totalprice_text"], "datatype": "double"}])


@query("dq_special_char", _inv_sql("special_character_check:o_orderpriority",
       f"regexp_matches(o_orderpriority, '{PAT}')"))
def dq_special_char(spark, d):
    return _invalid(spark, d, [{"type": "special_character_check", "columns": ["o_orderpriority"], "pattern": PAT}])


@query("dq_date_format", _inv_sql("date_format_check:o_orderdate_text",
       "o_orderdate_text IS NOT NULL AND try_strptime(o_orderdate_text, '%Y-%m-%d') IS NULL"))
def dq_date_format(spark, d):
    return _invalid(spark, d, [{"type": "date_format_check", "columns": ["o_orderdate_text"], "format": "yyyy-MM-dd"}])


@query("dq_fixed_length", _inv_sql("fixed_length_check:o_orderpriority", "length(o_orderpriority) <> 8"))
def dq_fixed_length(spark, d):
    return _invalid(spark, d, [{"type": "fixed_length_check", "columns": ["o_orderpriority"], "length": 8}])


@query("dq_valid_values", _inv_sql("valid_values_check:o_orderstatus", "NOT (o_orderstatus IN ('F', 'O'))"))
def dq_valid_values(spark, d):
    return _invalid(spark, d, [{"type": "valid_values_check", "columns": ["o_orderstatus"], "valid_values": ["F", "O"]}])


CHAIN = [
    {"type": "null_check", "columns": ["o_orderstatus"]},
    {"type": "datatype_check", "columns": ["o_totalprice_text"], "datatype": "double"},
    {"type": "date_format_check", "columns": ["o_orderdate_text"], "format": "yyyy-MM-dd"},
    {"type": "valid_values_check", "columns": ["o_orderpriority"], "valid_values": PRIORITIES},
]
CHAIN_SQL = D + f"""
SELECT o_orderkey, r = '' AS is_valid, NULLIF(r, '') AS invalid_reason FROM (SELECT o_orderkey, concat_ws('; ',
  CASE WHEN o_orderstatus IS NULL THEN 'null_check:o_orderstatus' END,
  CASE WHEN o_totalprice_text IS NOT NULL AND TRY_CAST(o_totalprice_text AS DOUBLE) IS NULL THEN 'datatype_check:o_totalprice_text' END,
  CASE WHEN o_orderdate_text IS NOT NULL AND try_strptime(o_orderdate_text, '%Y-%m-%d') IS NULL THEN 'date_format_check:o_orderdate_text' END,
  CASE WHEN NOT (o_orderpriority IN ({PRIO_SQL})) THEN 'valid_values_check:o_orderpriority' END) AS r FROM dirty_orders)"""


def _chain_out(f):
    return f.select("o_orderkey", (F.size("invalid_reasons") == 0).alias("is_valid"),
                    F.when(F.size("invalid_reasons") > 0, F.array_join("invalid_reasons", "; ")).alias("invalid_reason"))


@query("dq_chain", CHAIN_SQL)
def dq_chain(spark, d):
    return _chain_out(Q.flag(dirty_orders(spark, d), CHAIN))


@query("dq_from_table", CHAIN_SQL)
def dq_from_table(spark, d):
    rule_rows = spark.createDataFrame([
        (1, "null_check", "o_orderstatus", None),
        (2, "datatype_check", "o_totalprice_text", "double"),
        (3, "date_format_check", "o_orderdate_text", "yyyy-MM-dd"),
        (4, "valid_values_check", "o_orderpriority", "|".join(PRIORITIES)),
    ], "rule_id int, rule_type string, columns string, param string")
    checks = Q.checks_from_rows(rule_rows.orderBy("rule_id").collect())
    return _chain_out(Q.flag(dirty_orders(spark, d), checks))


@query("dq_active_passive", D + f"""
SELECT o_orderkey, a <> '' AS blocked, NULLIF(a, '') AS active_reason, NULLIF(p, '') AS passive_reason FROM (
 SELECT o_orderkey, concat_ws('; ',
   CASE WHEN o_orderstatus IS NULL THEN 'null_check:o_orderstatus' END,
   CASE WHEN o_totalprice_text IS NOT NULL AND TRY_CAST(o_totalprice_text AS DOUBLE) IS NULL THEN 'datatype_check:o_totalprice_text' END) AS a,
 concat_ws('; ',
   CASE WHEN regexp_matches(o_orderpriority, '{PAT}') THEN 'special_character_check:o_orderpriority' END,
   CASE WHEN length(o_orderpriority) <> 8 THEN 'fixed_length_check:o_orderpriority' END) AS p FROM dirty_orders)""")
def dq_active_passive(spark, d):
    active = [CHAIN[0], CHAIN[1]]
    passive = [{"type": "special_character_check", "columns": ["o_orderpriority"], "pattern": PAT},
               {"type": "fixed_length_check", "columns": ["o_orderpriority"], "length": 8}]
    return Q.active_passive(dirty_orders(spark, d), active, passive).select(
        "o_orderkey", "blocked", "active_reason", "passive_reason")


# ------------------------------------------------------------- flag by table
FLAG_RULES = [
    {"id": 101, "rule_dim_id": 1, "rule_type": "null_check", "column": "o_orderstatus"},
    {"id": 102, "rule_dim_id": 6, "rule_type": "special_character_check", "column": "o_orderpriority", "pattern": PAT},
    {"id": 103, "rule_dim_id": 7, "rule_type": "date_format_check", "column": "o_orderdate_text", "format": "yyyy-MM-dd"},
    {"id": 104, "rule_dim_id": 8, "rule_type": "fixed_length_check", "column": "o_orderpriority", "length": 8},
    {"id": 105, "rule_dim_id": 9, "rule_type": "valid_values_check", "column": "o_orderstatus", "valid_values": ["F", "O"]},
]
FLAG_CONDS = [
    ("101", 1, "o_orderstatus IS NULL"),
    ("102", 6, f"regexp_replace(o_orderpriority, '{PAT}', '', 'g') <> o_orderpriority"),
    ("103", 7, "o_orderdate_text IS NOT NULL AND try_strptime(o_orderdate_text, '%Y-%m-%d') IS NULL"),
    ("104", 8, "length(o_orderpriority) > 8"),
    ("105", 9, "NOT (o_orderstatus IN ('F', 'O'))"),
]


def _flags_sql(conds, src="dirty_orders d", prefix=D):
    arr = ", ".join(f"CASE WHEN {c} THEN '{i}' END" for i, _, c in conds)
    return prefix + f"""SELECT o_orderkey, r AS dq_result, CASE WHEN r <> '' THEN 'N' ELSE 'Y' END AS data_quality_valid_flag
FROM (SELECT o_orderkey, concat_ws(',', {arr}) AS r FROM {src})"""


def _flags_out(df):
    return df.select("o_orderkey", F.array_join("data_quality_result_array", ",").alias("dq_result"),
                     "data_quality_valid_flag")


@query("dq_flags", _flags_sql(FLAG_CONDS))
def dq_flags(spark, d):
    return _flags_out(Q.flag_rules(dirty_orders(spark, d), FLAG_RULES))


RANGE_TABLE_RULES = [
    {"id": 201, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "<", "low": 450000},
    {"id": 202, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": ">", "low": 2000},
    {"id": 203, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "between", "low": 1500, "high": 480000},
    {"id": 204, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "not between", "low": 200000, "high": 200500},
    {"id": 205, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_custkey", "operator": "<>", "low": 7},
    {"id": 206, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_orderstatus", "operator": "=", "low": "F"},
]


@query("dq_flags_range", _flags_sql([
    ("201", 2, "coalesce(NOT (o_totalprice < 450000), false)"),
    ("202", 2, "coalesce(NOT (o_totalprice > 2000), false)"),
    ("203", 2, "coalesce(NOT (o_totalprice BETWEEN 1500 AND 480000), false)"),
    ("204", 2, "coalesce(o_totalprice BETWEEN 200000 AND 200500, false)"),
    ("205", 2, "coalesce(o_custkey = 7, false)"),
    ("206", 2, "coalesce(o_orderstatus <> 'F', false)"),
]))
def dq_flags_range(spark, d):
    return _flags_out(Q.flag_rules(dirty_orders(spark, d), RANGE_TABLE_RULES, mode="valid_if"))


@query("dq_labels", D + """
SELECT o_orderkey,
  CASE WHEN o_orderstatus IS NULL THEN 'Failed_' ELSE 'Passed_' END || 'o_orderstatus' AS label_101,
  CASE WHEN length(o_orderpriority) > 8 THEN 'Failed_' ELSE 'Passed_' END || 'o_orderpriority' AS label_104,
  CASE WHEN coalesce(NOT (o_orderstatus IN ('F', 'O')), false) THEN 'Failed_' ELSE 'Passed_' END || 'o_orderstatus' AS label_105
FROM dirty_orders""")
def dq_labels(spark, d):
    rules = [FLAG_RULES[0], FLAG_RULES[3], FLAG_RULES[4]]
    return Q.labels(dirty_orders(spark, d), rules).select("o_orderkey", "label_101", "label_104", "label_105")


def _duck_type(c):
    base = f"lower(split_part(typeof({c}), '(', 1))"
    return f"CASE {base} WHEN 'varchar' THEN 'string' WHEN 'integer' THEN 'int' ELSE {base} END"


TYPE_RULES = [
    {"id": 301, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "o_totalprice", "expected": "double"},
    {"id": 302, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "o_orderstatus", "expected": "string"},
    {"id": 303, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "o_custkey", "expected": "int"},
    {"id": 304, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "o_price_dec", "expected": "decimal"},
]


@query("dq_typeof", _flags_sql([
    (str(r["id"]), 5, f"{_duck_type(r['column'])} <> '{r['expected']}'") for r in TYPE_RULES],
    src="(SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS o_price_dec FROM dirty_orders) d"))
def dq_typeof(spark, d):
    df = dirty_orders(spark, d).withColumn("o_price_dec", F.col("o_totalprice").cast("decimal(12,2)"))
    return _flags_out(Q.flag_rules(df, TYPE_RULES))


@query("dq_unique_flag", _flags_sql([("401", 3, "count(*) OVER (PARTITION BY o_custkey) > 1")]))
def dq_unique_flag(spark, d):
    rules = [{"id": 401, "rule_dim_id": 3, "rule_type": "unique_check", "column": "o_custkey"}]
    return _flags_out(Q.flag_rules(dirty_orders(spark, d), rules))


@query("dq_orphan_related", _flags_sql([
    ("501", 4, "NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.o_custkey)")]))
def dq_orphan_related(spark, d):
    rules = [{"id": 501, "rule_dim_id": 4, "rule_type": "orphan_check", "column": "o_custkey",
              "related": table(spark, d, "customer"), "related_column": "c_custkey"}]
    return _flags_out(Q.flag_rules(dirty_orders(spark, d), rules))


@query("dq_flag_merge", D + f"""
SELECT t.*, f.data_quality_valid_flag, f.dq_result AS data_quality_result_array
FROM dirty_orders t LEFT JOIN ({_flags_sql(FLAG_CONDS, prefix='')}) f ON t.o_orderkey = f.o_orderkey""")
def dq_flag_merge(spark, d):
    dirty = dirty_orders(spark, d)
    target = dirty.withColumns({"data_quality_valid_flag": F.lit(None).cast("string"),
                                "data_quality_result_array": F.lit(None).cast("string")})
    flags = _flags_out(Q.flag_rules(dirty, FLAG_RULES)).withColumnRenamed("dq_result", "data_quality_result_array")
    return scd.scd1(target, flags, ["o_orderkey"],
                    update=["data_quality_valid_flag", "data_quality_result_array"], insert=[])


# ------------------------------------------------------------- rule catalogs
def _value_rows(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return (o.select(F.lit(1).alias("list_id"), F.col("o_orderstatus").alias("column_value"))
            .unionByName(c.select(F.lit(2).alias("list_id"), F.col("c_mktsegment").alias("column_value")))
            .unionByName(o.select(F.lit(3).alias("list_id"), F.col("o_orderpriority").alias("column_value"))))


VALUES_SQL = """v AS (SELECT 1 AS list_id, o_orderstatus AS column_value FROM orders
  UNION ALL SELECT 2, c_mktsegment FROM customer UNION ALL SELECT 3, o_orderpriority FROM orders),
lists AS (SELECT list_id, string_agg(q, ',' ORDER BY q) AS valid_list
  FROM (SELECT DISTINCT list_id, '''' || column_value || '''' AS q FROM v) GROUP BY list_id)
"""


@query("dq_value_lists", "WITH " + VALUES_SQL + "SELECT * FROM lists")
def dq_value_lists(spark, d):
    return Q.value_lists(_value_rows(spark, d))


REL_ROWS = [
    (11, 1, "sales", "orders", "o_orderstatus", None, None, None, None, "flag"),
    (12, 9, "sales", "orders", "o_orderstatus", "in", None, None, 1, "flag"),
    (13, 9, "sales", "customer", "c_mktsegment", "in", None, None, 2, "flag"),
    (14, 2, "sales", "orders", "o_totalprice", "between", 1000.0, 450000.0, None, "immediate"),
    (15, 9, "sales", "orders", "o_orderpriority", "in", None, None, 3, "flag"),
    (16, 8, "sales", "orders", "o_orderpriority", ">", 8.0, None, None, "flag"),
]
DIM_ROWS = [(1, "null_check", "value must be present", "Y"), (2, "range_check", "value in range", "Y"),
            (8, "fixed_length_check", "text not longer than n", "N"), (9, "valid_values_check", "value in list", "Y")]
REL_SCHEMA = ("rule_object_rel_id int, rule_dim_id int, database_name string, table_name string, column_name string, "
              "operator string, threshold_low double, threshold_high double, valid_list_id int, implement_type string")
DIM_SCHEMA = "rule_dim_id int, rule_type_desc string, rule_desc string, enabled string"


def _sql_val(v):
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _values(rows, cols):
    body = ",\n ".join("(" + ", ".join(_sql_val(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({cols})"


REL_COLS = ("rule_object_rel_id, rule_dim_id, database_name, table_name, column_name, operator, threshold_low, "
            "threshold_high, valid_list_id, implement_type")


@query("dq_rule_catalog", "WITH " + VALUES_SQL + f""", rel AS ({_values(REL_ROWS, REL_COLS)}),
dim AS ({_values(DIM_ROWS, 'rule_dim_id, rule_type_desc, rule_desc, enabled')})
SELECT r.rule_object_rel_id, r.rule_dim_id, d.rule_type_desc, r.table_name, r.column_name, r.operator,
  CAST(r.threshold_low AS DOUBLE) AS threshold_low, CAST(r.threshold_high AS DOUBLE) AS threshold_high,
  replace(l.valid_list, '|', ',') AS valid_list,
  CAST(row_number() OVER (PARTITION BY r.table_name ORDER BY r.rule_object_rel_id) AS INTEGER) AS rule_no
FROM rel r JOIN dim d ON r.rule_dim_id = d.rule_dim_id LEFT JOIN lists l ON r.valid_list_id = l.list_id
WHERE upper(d.enabled) = 'Y' AND r.implement_type = 'flag'""")
def dq_rule_catalog(spark, d):
    rel = spark.createDataFrame(REL_ROWS, REL_SCHEMA)
    dim = spark.createDataFrame(DIM_ROWS, DIM_SCHEMA)
    return Q.rule_catalog(rel, dim, Q.value_lists(_value_rows(spark, d)), "flag")


def _count_sql(conds):
    return D + "\nUNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS rule_object_rel_id, CAST({dim} AS BIGINT) AS rule_dim_id, "
        f"count(*) FILTER (WHERE {c}) AS violations FROM dirty_orders d" for i, dim, c in conds)


@query("dq_rule_counts", _count_sql(FLAG_CONDS))
def dq_rule_counts(spark, d):
    return Q.rule_counts(dirty_orders(spark, d), FLAG_RULES)


IMMEDIATE_RULES = [
    {"id": 601, "rule_dim_id": 1, "rule_type": "null_check", "column": "o_orderstatus"},
    {"id": 602, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "<", "low": 5000},
    {"id": 603, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "between", "low": 200000, "high": 200500},
    {"id": 604, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_totalprice", "operator": "not between", "low": 1000, "high": 450000},
    {"id": 605, "rule_dim_id": 9, "rule_type": "valid_values_check", "column": "o_orderstatus", "valid_values": ["F", "O", "P"]},
]
IMMEDIATE_CONDS = [
    ("601", 1, "o_orderstatus IS NULL"),
    ("602", 2, "coalesce(o_totalprice < 5000, false)"),
    ("603", 2, "coalesce(o_totalprice BETWEEN 200000 AND 200500, false)"),
    ("604", 2, "coalesce(NOT (NOT (o_totalprice BETWEEN 1000 AND 450000)), false)"),
    ("605", 9, "coalesce(NOT (o_orderstatus IN ('F', 'O', 'P')), false)"),
]


@query("dq_sample_fact", D + "SELECT CAST(77 AS BIGINT) AS audit_dim_id, rule_dim_id, rule_object_rel_id, "
       f"TIMESTAMP '{AS_OF}' AS dq_sample_timestamp, violations AS dq_sample_result, 'N' AS dq_sample_pass, "
       "'N' AS dq_notification_required, 'flaged' AS dq_action_taken FROM ("
       + _count_sql(IMMEDIATE_CONDS)[len(D):] + ")")
def dq_sample_fact(spark, d):
    return Q.sample_fact(dirty_orders(spark, d), IMMEDIATE_RULES, 77, AS_OF)


def _flagged_orders(spark, d):
    return dirty_orders(spark, d).withColumn(
        "valid_flag", F.when(F.col("o_orderstatus") == "F", "y").when(F.col("o_orderstatus") == "O", "Y").otherwise("N"))


@query("dq_immediate", D + f"""
SELECT o_orderkey, CASE WHEN coalesce(hit0, false) THEN 'n' ELSE valid_flag END AS valid_flag,
  coalesce(hit0, false) AS dq_updated FROM (
 SELECT o_orderkey, valid_flag, ({' OR '.join(c for _, _, c in [IMMEDIATE_CONDS[0], IMMEDIATE_CONDS[1], IMMEDIATE_CONDS[4]])})
   AND upper(valid_flag) = 'Y' AS hit0
 FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'y' WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS valid_flag
       FROM dirty_orders))""")
def dq_immediate(spark, d):
    rules = [IMMEDIATE_RULES[0], IMMEDIATE_RULES[1], IMMEDIATE_RULES[4]]
    return Q.immediate_update(_flagged_orders(spark, d), rules).select("o_orderkey", "valid_flag", "dq_updated")


IMM_RANGE = IMMEDIATE_RULES[1:4] + [
    {"id": 606, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_custkey", "operator": "<>", "low": 7},
    {"id": 607, "rule_dim_id": 2, "rule_type": "range_check", "column": "o_orderstatus", "operator": "=", "low": "F"},
]


@query("dq_immediate_range", _flags_sql(IMMEDIATE_CONDS[1:4] + [
    ("606", 2, "coalesce(o_custkey = 7, false)"), ("607", 2, "coalesce(o_orderstatus <> 'F', false)")]))
def dq_immediate_range(spark, d):
    return _flags_out(Q.flag_rules(dirty_orders(spark, d), IMM_RANGE, mode="flag_if"))
