"""Physical-plan properties the scale design relies on."""

import pytest

from curata.operators import incremental, scd
from curata.workload import QUERIES
from curata.workload.inputs import table

WRITES = ("src_", "sink_", "stream_", "pipe_stream")     # keys that write while being built


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith(WRITES)))
def test_no_python_udf_no_cross_join(spark, sf, name):
    plan = _plan(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_late_calendar_and_newest_file_plans(spark, sf):
    assert "BroadcastNestedLoopJoin" not in _plan(QUERIES["late_demand_forecast"](spark, sf))
    from curata.session import scratch_path
    from curata.sources import files
    root = scratch_path(spark, "listing")
    spark.range(3).write.json(root)
    plan = _plan(files.latest_file(spark, "json", root))
    assert "binaryFile" in plan and "content" not in plan.split("ReadSchema")[-1]


def test_one_pass_duplicate_flags(spark, sf):
    from curata.operators import quality
    o = table(spark, sf, "orders")
    plan = _plan(quality.with_duplicate_marker(o, ["o_custkey"], ["o_orderkey"], "again"))
    assert "Generate" not in plan and "Union" not in plan


def test_incremental_window_is_pushed_to_the_scan(spark, sf):
    df = incremental.window(table(spark, sf, "orders"), "o_orderdate", "1999-01-01 00:00:00")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan


def test_upsert_anti_join_reads_only_keys(spark, sf):
    o = table(spark, sf, "orders")
    plan = _plan(scd.scd1(o.where("o_orderkey % 5 <> 0"), o.where("o_orderkey % 3 = 0"), ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_point_in_interval_join_rides_on_the_key(spark, sf):
    plan = _plan(QUERIES["late_dc_items"](spark, sf))
    assert ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan or "ShuffledHashJoin" in plan)
    assert "LeftAnti" in plan


def test_type2_merges_evaluate_the_batch_once(spark, sf):
    """No late row: closed history is passed through, the batch is scanned once and the merge
    input has an exchange per side."""
    from curata.workload.inputs import LI_KEYS, LI_TIES, li_batch
    from pyspark.sql import functions as F
    from curata.session import scratch_path
    root = scratch_path(spark, "t-plan")
    li = li_batch(spark, sf).withColumns({"start_time": F.col("l_shipdate"), "is_deleted": F.lit(0)})
    old = li.where("l_shipdate < '1998-01-01'")
    scd.scd2_first_load(old, LI_KEYS, "start_time", LI_TIES).write.parquet(f"{root}/hist")
    li.where("l_shipdate >= '1998-01-01'").dropDuplicates(LI_KEYS).write.parquet(f"{root}/batch")
    hist, batch = spark.read.parquet(f"{root}/hist"), spark.read.parquet(f"{root}/batch")
    for df in (scd.scd2(hist, batch, LI_KEYS, "start_time"), scd.scd2_versions(hist, batch, LI_KEYS, "start_time", LI_TIES)):
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning") <= 2, plan
        assert plan.count(f"{root}/batch") <= 1 or plan.count("/batch]") == 1, plan
        assert plan.count("FileScan parquet") == 3, plan                       # open rows, closed rows, batch


def test_late_type2_merge_computes_its_inputs_once(spark):
    """Late rows: target and batch that take a shuffle are staged, not computed again by every step."""
    from pyspark.sql import functions as F
    from curata.session import scratch_path
    root = scratch_path(spark, "t-late")
    rows = [(k, v, f"2020-01-0{day}") for k in range(20) for v, day in (("a", 1), ("b", 3), ("b", 3), ("c", 5))]
    raw = spark.createDataFrame(rows, "k int, v string, day string")
    raw.selectExpr("k", "v", "CAST(day AS timestamp_ntz) AS start_time", "0 AS is_deleted").write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    first = scd.scd2_first_load(raw.where("v <> 'a'").distinct(), ["k"], "start_time", skew=False)
    out = scd.scd2_versions(first, raw.distinct(), ["k"], "start_time", skew=False)
    assert f"{root}/raw" not in _plan(out)
    want = scd.scd2_first_load(raw.distinct(), ["k"], "start_time", skew=False).select(*out.columns)
    assert out.count() == 60 and out.exceptAll(want).count() == 0
    files = scd.scd2_versions(spark.read.parquet(f"{root}/raw").withColumns({"end_time": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(1)}),
                              raw, ["k"], "start_time", skew=False)
    assert f"{root}/raw" in _plan(files)                                         # read straight from files: not staged


def test_versions_of_a_hot_key_meet_in_no_task(spark):
    from curata.operators import dedupe
    from pyspark.sql import functions as F
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), (F.col("id") % 3).alias("v"))
    out = dedupe.versions_per_key(df, ["k"], "t", skew={"partitions": 8})
    largest = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < 9000                                                       # 18,000 rows share a key
    plain = dedupe.versions_per_key(df, ["k"], "t", skew=False)
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    plan = _plan(out)
    assert "BroadcastExchange" not in plan and "_part" in plan
