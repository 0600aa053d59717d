"""Data-quality checks, including the fixed reference defects."""

from pyspark.sql import functions as F

from curata.operators import quality as Q
from tests.conftest import rows


def _df(spark):
    return spark.createDataFrame(
        [(1, "a", None, 5.0, "2024-01-02"), (2, None, "x", 50.0, "2024/01/02"), (3, "c#", "y", 500.0, None)],
        "id int, s1 string, s2 string, n double, d string")


def test_rows_in_equals_valid_plus_invalid(spark):
    df = _df(spark)
    checks = [{"type": "null_check", "columns": ["s1", "s2"]},
              {"type": "range_check", "columns": ["n"], "rules": [{"type": "higher_than", "threshold": 100}]}]
    valid, invalid = Q.split(df, checks)
    assert valid.count() + invalid.count() == df.count()


def test_any_listed_column_flags(spark):
    # the reference only filtered on the last column of a multi-column check
    valid, invalid = Q.split(_df(spark), [{"type": "null_check", "columns": ["s1", "s2"]}])
    assert rows(invalid, "id") == [(1,), (2,)]


def test_all_reasons_kept(spark):
    checks = [{"type": "null_check", "columns": ["s2"]},
              {"type": "date_format_check", "columns": ["d"], "format": "yyyy-MM-dd"},
              {"type": "special_character_check", "columns": ["s1"]}]
    f = Q.flag(_df(spark), checks)
    got = {r["id"]: r["invalid_reasons"] for r in f.collect()}
    assert got[1] == ["null_check:s2"]
    assert got[2] == ["date_format_check:d"]
    assert got[3] == ["special_character_check:s1"]


def test_valid_range_flags_outside(spark):
    chk = [{"type": "range_check", "columns": ["n"], "rules": [{"type": "valid_range", "range": [10, 100]}]}]
    _, invalid = Q.split(_df(spark), chk)
    assert rows(invalid, "id") == [(1,), (3,)]


def test_datatype_check_uses_try_cast(spark):
    df = spark.createDataFrame([("12.5",), ("x12",), (None,)], "p string")
    _, invalid = Q.split(df, [{"type": "datatype_check", "columns": ["p"], "datatype": "double"}])
    assert rows(invalid, "p") == [("x12",)]


def test_unique_marks_all_but_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, g string")
    _, invalid = Q.split(df, [{"type": "unique_check", "columns": ["g"], "order": ["id"]}])
    assert rows(invalid, "id") == [(2,), (5,)]


def test_orphan_no_fanout_on_duplicate_related_keys(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, fk int")
    rel = spark.createDataFrame([(10,), (10,), (10,)], "pk int")
    valid, invalid = Q.split(df, [{"type": "orphan_check", "columns": ["fk"], "related": rel, "related_column": "pk"}])
    assert valid.count() + invalid.count() == 3
    assert rows(invalid, "id") == [(2,), (3,)]


def test_range_modes(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0)], "id int, n double")
    valid_if = [{"id": 1, "rule_dim_id": 2, "rule_type": "range_check", "column": "n", "operator": "<", "low": 10}]
    a = Q.flag_rules(df, valid_if, mode="valid_if")
    b = Q.flag_rules(df, valid_if, mode="flag_if")
    assert rows(a, "id", "data_quality_valid_flag") == [(1, "Y"), (2, "N")]
    assert rows(b, "id", "data_quality_valid_flag") == [(1, "N"), (2, "Y")]


def test_result_array_is_compact(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    out = Q.flag_rules(df, [{"id": 9, "rule_dim_id": 1, "rule_type": "null_check", "column": "s"}])
    r = out.first()
    assert r["data_quality_result_array"] == [] and r["data_quality_valid_flag"] == "Y"


def test_typeof_base_name(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string").withColumn("dec", F.lit(1).cast("decimal(5,2)"))
    rules = [{"id": 1, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "s", "expected": "string"},
             {"id": 2, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "dec", "expected": "decimal"},
             {"id": 3, "rule_dim_id": 5, "rule_type": "datatype_check", "column": "id", "expected": "bigint"}]
    assert Q.flag_rules(df, rules).first()["data_quality_result_array"] == ["3"]


def test_rule_counts_and_immediate(spark):
    df = spark.createDataFrame([(1, None, "Y"), (2, "a", "y"), (3, None, "N")], "id int, s string, valid_flag string")
    rule = [{"id": 7, "rule_dim_id": 1, "rule_type": "null_check", "column": "s"}]
    assert rows(Q.rule_counts(df, rule)) == [(7, 1, 2)]
    upd = Q.immediate_update(df, rule)
    assert rows(upd, "id", "valid_flag") == [(1, "n"), (2, "y"), (3, "N")]
    assert upd.where("dq_updated").count() == 1


def test_checks_from_rule_rows(spark):
    rr = spark.createDataFrame([("fixed_length_check", "s1", "1"), ("valid_values_check", "s2", "x|y")],
                               "rule_type string, columns string, param string")
    checks = Q.checks_from_rows(rr.collect())
    assert checks[0]["length"] == 1 and checks[1]["valid_values"] == ["x", "y"]
    _, invalid = Q.split(_df(spark), checks)
    assert rows(invalid, "id") == [(3,)]


def test_valid_values_from_table_equals_list(spark):
    df = _df(spark)
    allowed = spark.createDataFrame([("x",), ("y",), ("y",)], "v string")
    by_list = Q.split(df, [{"type": "valid_values_check", "columns": ["s2"], "valid_values": ["x"]}])[1]
    by_table = Q.split(df, [{"type": "valid_values_check", "columns": ["s2"], "values_from": allowed.where("v = 'x'"),
                             "values_column": "v"}])[1]
    assert rows(by_list, "id") == rows(by_table, "id") == [(3,)]


def test_unique_without_order_and_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, g string")
    valid, invalid = Q.split(df, [{"type": "unique_check", "columns": ["g"]}])
    assert valid.count() + invalid.count() == 6
    assert rows(valid.groupBy("g").count(), "g", "count") == [(None, 1), ("a", 1), ("b", 1)]
    exact = spark.createDataFrame([(7, "x"), (7, "x"), (7, "x")], "id int, g string")
    v2, i2 = Q.split(exact, [{"type": "unique_check", "columns": ["g"], "order": ["id"]}])
    assert v2.count() == 1 and i2.count() == 2
