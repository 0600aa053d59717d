"""Step chain: every op works, with the argument shapes of a step dict."""

import pytest

from curata.plans import steps
from tests.conftest import rows


def test_empty_chain_returns_pair(spark):
    df = spark.range(3)
    out, ids = steps.run(df, [])
    assert ids == [] and out.count() == 3


def test_all_ops(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", "x"), (2, "c", "x")], "id int, `na me` string, `x/y` string")
    chain = steps.StepChain()
    chain.add({"op": "normalize"}).add_all([
        {"op": "where", "expr": "id > 0"},
        {"op": "fillna", "value": "na"},
        {"op": "distinct"},
        {"op": "rename", "mapping": {"na_me": "name"}},
        {"op": "cast", "types": {"id": "bigint"}},
        {"op": "select", "columns": ["id", "name", "x_y", "id * 2 AS id2"]},
        {"op": "drop", "columns": ["id2", "absent"]},
        {"op": "sql", "text": "SELECT * FROM {table_view} WHERE id < {hi}", "params": {"hi": 10}},
        {"op": "py", "name": "tag", "args": {"value": "t"}},
    ])
    chain.registry["tag"] = lambda d, value: d.withColumn("tag", __import__("pyspark.sql.functions").sql.functions.lit(value))
    assert len(chain) == 10
    out, ids = chain.run(df)
    assert len(ids) == 10
    assert rows(out) == [(1, "a b", "na", "t"), (2, "c", "x", "t")]


def test_positional_names_mismatch(spark):
    with pytest.raises(ValueError):
        steps.positional_names(spark.range(1), ["a", "b"])


def test_unknown_op(spark):
    with pytest.raises(ValueError):
        steps.run(spark.range(1), [{"op": "explode-everything"}])


def test_safe_cast_quarantines(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    out = steps.cast(df, {"v": "int"}, safe=True)
    assert rows(out) == [(None,), (1,)]


def test_observe_count_without_extra_job(spark):
    df, obs = steps.observe_count(spark.range(7))
    assert df.count() == 7
    assert obs.get["rows"] == 7
