"""Query keys: the scalar function families used by the loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from .inputs import table
from .registry import query


@query("fn_string", """
SELECT p_partkey, concat(p_brand, '/', p_type) AS c_concat, concat_ws('|', p_name, p_brand) AS c_concat_ws,
  replace(p_brand, 'Brand#', 'B') AS c_replace, regexp_replace(p_name, '[aeiou]', '*', 'g') AS c_regexp,
  regexp_matches(p_name, '^s') AS c_rlike, split_part(p_name, ' ', 1) AS c_split, substr(p_type, 1, 3) AS c_substr,
  CAST(instr(p_name, 'e') AS INTEGER) AS c_instr, CAST(length(p_name) AS INTEGER) AS c_len, lower(p_type) AS c_lower,
  upper(p_name) AS c_upper, p_brand || '-' || p_type AS c_pipe FROM part""")
def fn_string(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("c_concat"),
        F.concat_ws("|", "p_name", "p_brand").alias("c_concat_ws"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("c_replace"),
        F.regexp_replace("p_name", "[aeiou]", "*").alias("c_regexp"),
        F.col("p_name").rlike("^s").alias("c_rlike"), F.split("p_name", " ").getItem(0).alias("c_split"),
        F.substring("p_type", 1, 3).alias("c_substr"), F.instr("p_name", "e").alias("c_instr"),
        F.length("p_name").alias("c_len"), F.lower("p_type").alias("c_lower"), F.upper("p_name").alias("c_upper"),
        F.expr("p_brand || '-' || p_type").alias("c_pipe"))


@query("fn_datetime", """
SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS d_days,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d_ts,
  o_orderdate - INTERVAL 1 SECOND AS d_minus_1s, o_orderdate - INTERVAL 1 MILLISECOND AS d_minus_1ms,
  strftime(o_orderdate, '%Y-%m-%d') AS d_text,
  try_strptime(strftime(o_orderdate, '%Y/%m/%d'), '%Y-%m-%d') IS NULL AS d_bad_is_null,
  CAST(CAST(try_strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS TIMESTAMP) AS d_parsed,
  CAST(year(o_orderdate) AS INTEGER) AS d_year, CAST(month(o_orderdate) AS INTEGER) AS d_month FROM orders""")
def fn_datetime(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("d_days"),
        F.to_date("o_orderdate").cast("timestamp_ntz").alias("d_ts"),
        (F.col("o_orderdate") - F.expr("INTERVAL 1 SECOND")).alias("d_minus_1s"),
        (F.col("o_orderdate") - F.expr("INTERVAL 1 MILLISECOND")).alias("d_minus_1ms"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d_text"),
        F.try_to_date(F.date_format("o_orderdate", "yyyy/MM/dd"), "yyyy-MM-dd").isNull().alias("d_bad_is_null"),
        F.try_to_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").cast("timestamp_ntz").alias("d_parsed"),
        F.year("o_orderdate").alias("d_year"), F.month("o_orderdate").alias("d_month"))


@query("fn_conditional", """
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS c_case,
  coalesce(nullif(o_orderpriority, '5-LOW'), o_orderstatus) AS c_coalesce,
  coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS c_nvl, greatest(o_totalprice, 100000.0) AS c_greatest,
  nullif(o_orderpriority, '5-LOW') IS NULL AS c_isnull, o_orderstatus IN ('F', 'O') AS c_in,
  o_orderstatus NOT IN ('F', 'O') AS c_not_in, o_totalprice BETWEEN 1000 AND 5000 AS c_between FROM orders""")
def fn_conditional(spark, d):
    o = table(spark, d, "orders")
    low = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return o.select(
        "o_orderkey", F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("c_case"),
        F.coalesce(low, "o_orderstatus").alias("c_coalesce"), F.nvl(low, F.lit("none")).alias("c_nvl"),
        F.greatest("o_totalprice", F.lit(100000.0)).alias("c_greatest"), F.isnull(low).alias("c_isnull"),
        F.col("o_orderstatus").isin("F", "O").alias("c_in"), (~F.col("o_orderstatus").isin("F", "O")).alias("c_not_in"),
        F.col("o_totalprice").between(1000, 5000).alias("c_between"))


@query("fn_nested", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS n_events,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
  CAST(to_json(struct_pack(user_id := user_id, n_events := count(*))) AS VARCHAR) AS info,
  CAST(max(len([event_type, CAST(event_id AS VARCHAR)])) AS INTEGER) AS arr_size FROM events GROUP BY user_id""")
def fn_nested(spark, d):
    ev = table(spark, d, "events")
    kv = ev.select("user_id", "event_type", "event_id",
                   F.explode(F.from_json("props", "map<string,int>")).alias("k", "v"))
    agg = kv.groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("types"),
        F.count(F.lit(1)).alias("n_events"), F.sum("v").alias("k_sum"),
        F.max(F.size(F.array("event_type", F.col("event_id").cast("string")))).alias("arr_size"))
    return agg.withColumn("info", F.to_json(F.struct("user_id", "n_events"))).select(
        "user_id", "types", "n_events", "k_sum", "info", "arr_size")
