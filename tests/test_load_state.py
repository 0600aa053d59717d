"""Loads with state, several targets from one evaluation, counted merges."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from curata.operators import audit, scd
from curata.plans import loader, state
from curata.session import scratch_path
from curata.sources import sinks
from tests.conftest import rows

T = dt.datetime
SCHEMA = "k int, v string, ts timestamp_ntz"


def _config(root, **more):
    return {"source": {"source_table_type": "path", "initial_filepath": f"{root}/initial", "delta_filepath": f"{root}/delta"},
            "change_col": "ts", "load": {"type": "update", "keys": ["k"], "order": ["ts"]}, **more}


def _landed(spark, root):
    spark.createDataFrame([(1, "a", T(2020, 1, 1)), (2, "b", T(2020, 1, 2))], SCHEMA).write.parquet(f"{root}/initial")
    spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "a2", T(2020, 2, 1)), (3, "c", T(2020, 3, 1))], SCHEMA).write.parquet(f"{root}/delta")


def test_flag_watermark_and_content_advance_together(spark):
    root = scratch_path(spark, "t-state")
    _landed(spark, root)
    cfg, where = _config(root), f"{root}/load"
    assert state.current(spark, where) == state.LoadState() and state.table(spark, state.LoadState()) is None
    one = state.run(spark, cfg, where)
    assert (one.number, one.is_initial_completed, one.watermark, one.rows_loaded) == (1, True, "2020-01-02 00:00:00", 2)
    broken = _config(root, steps=[{"op": "where", "expr": "raise_error('broke') IS NULL"}])
    with pytest.raises(Exception, match="broke"):
        state.run(spark, broken, where)
    assert state.current(spark, where) == one                              # a failed load is no load
    two = state.run(spark, cfg, where, until="2020-02-15 00:00:00")
    assert two.rows_loaded == 1 and rows(state.table(spark, two), "k", "v") == [(1, "a2"), (2, "b")]
    assert rows(state.table(spark, one), "k", "v") == [(1, "a"), (2, "b")]
    three = state.run(spark, cfg, where)
    assert (three.number, three.watermark, three.rows_loaded) == (3, "2020-03-01 00:00:00", 1)
    assert state.run(spark, cfg, where) == three                           # nothing new
    assert rows(state.table(spark, three), "k", "v") == [(1, "a2"), (2, "b"), (3, "c")]


def test_two_loads_from_one_state_cannot_both_commit(spark):
    from curata.sources import commits
    root = scratch_path(spark, "t-commit")
    commits.write(spark, root, 1, {"a": 1}, replace=False)
    with pytest.raises(FileExistsError):
        commits.write(spark, root, 1, {"a": 2}, replace=False)
    assert commits.read(spark, root, 1) == {"a": 1} and commits.numbers(spark, root) == [1]


def test_targets_share_one_evaluation_and_move_together(spark):
    root = scratch_path(spark, "t-targets")
    tag = root.rsplit("-", 1)[-1]
    spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "b", T(2020, 2, 1)), (2, None, T(2020, 1, 1))], SCHEMA).write.parquet(f"{root}/src")
    load = {"keys": ["k"], "order": ["ts"]}
    a, b = f"curata_ta_{tag}", f"curata_tb_{tag}"
    cfg = {"source": {"source_table_type": "path", "path": f"{root}/src"}, "dq": {"active": [{"type": "null_check", "columns": ["v"]}]},
           "targets": {a: {**load, "type": "update"}, b: {**load, "type": "append"}}}
    got = loader.run_targets(spark, cfg, {})
    for df in got.values():
        assert df.inputFiles() and not any(f"{root}/src" in f for f in df.inputFiles())       # both read the staged rows
    loader.load_targets(spark, cfg, f"{root}/tables")
    loader.load_targets(spark, cfg, f"{root}/tables")
    assert rows(spark.table(a), "k", "v") == [(1, "b")] and spark.table(b).count() == 4
    bad = {**cfg, "targets": {a: {**load, "type": "complete"}, b: {**load, "type": "full_compare"}}}        # b needs as_of
    with pytest.raises(ValueError):
        loader.load_targets(spark, bad, f"{root}/tables")
    broken = spark.table(a).withColumn("v", F.when(F.col("k") > 0, F.raise_error(F.lit("broke"))).cast("string"))
    with pytest.raises(Exception, match="broke"):
        sinks.publish_together(spark, {b: spark.table(b).limit(1), a: broken}, f"{root}/tables")
    assert rows(spark.table(a), "k", "v") == [(1, "b")] and spark.table(b).count() == 4       # neither moved
    with pytest.raises(Exception):                                                            # a name that no catalog takes
        sinks.publish_together(spark, {b: spark.table(b).limit(1), "no_such_db.t": spark.table(b)}, f"{root}/tables")
    assert spark.table(b).count() == 4                                                        # moved back


def test_merge_counts_come_from_the_write(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    new, seen = audit.counted(scd.scd1_full_join(t, s, ["k"], action_col="act"), "act")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "CollectMetrics" in plan
    new.write.parquet(scratch_path(spark, "t-counted"))
    assert seen.get == {"KEEP": 1, "UPDATE": 1, "INSERT": 1}
    assert rows(audit.counts_row(spark, seen.get)) == [(2, 2, 3)]


def test_strict_reconcile_raises(spark):
    a, b = spark.range(10), spark.range(5)
    assert rows(audit.reconcile(a, b), "is_reconciled") == [(False,)]
    assert rows(audit.reconcile(a, a, strict=True), "is_reconciled") == [(True,)]
    with pytest.raises(Exception, match="counts differ"):
        audit.reconcile(a, b, strict=True).collect()
    with pytest.raises(Exception, match="counts differ"):
        audit.reconcile(a, b, strict=True).write.format("noop").mode("overwrite").save()


def test_command_line_targets_streams_and_state(spark, tmp_path):
    from curata.__main__ import main
    root = scratch_path(spark, "t-cli")
    tag = root.rsplit("-", 1)[-1]
    _landed(spark, root)
    load = {"type": "update", "keys": ["k"], "order": ["ts"]}

    def run(name, cfg):
        p = tmp_path / f"{name}.json"
        p.write_text(json.dumps(cfg))
        return main([str(p)], spark=spark)
    out = run("targets", {"source": {"source_table_type": "path", "path": f"{root}/delta"}, "root": f"{root}/tables",
                          "targets": {f"curata_c1_{tag}": load, f"curata_c2_{tag}": {**load, "type": "append"}}})
    assert set(out["snapshots"]) == {f"curata_c1_{tag}", f"curata_c2_{tag}"} and spark.table(f"curata_c2_{tag}").count() == 3
    stream = {"source": {"streaming": True, "format": "parquet", "path": f"{root}/delta"}, "load": load,
              "root": f"{root}/stream", "checkpoint": f"{root}/_ck"}
    assert run("stream", stream) == {"rows": 2} and run("again", stream) == {"rows": 2}
    assert run("state", {**_config(root), "state": {"root": f"{root}/load"}})["number"] == 1
