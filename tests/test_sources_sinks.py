"""Readers, sinks, snapshot publish, JDBC round trip (embedded Derby)."""

import os

import pytest

from curata.session import scratch_path
from curata.sources import control, files, jdbc, sinks, tables
from tests.conftest import rows


def test_lineage_columns(spark, sf):
    df = files.read_parquet(spark, f"{sf}/nation.parquet", options={})
    assert {"file_path", "file_modification_time", "is_current", "is_deleted", "start_time"} <= set(df.columns)
    assert df.where("file_path LIKE '%nation.parquet'").count() == df.count()


def test_table_name_rules(spark):
    assert tables.qualify_two_level("t") == "default.t"
    with pytest.raises(ValueError):
        tables.read_three_level(spark, "schema.table")


def test_unknown_write_mode(spark):
    with pytest.raises(ValueError):
        sinks.write(spark.range(1), "upsert", path="/nonexistent")


def test_empty_source(spark):
    assert files.is_empty(spark.range(0))


def test_publish_snapshot_repoints(spark):
    root = scratch_path(spark, "publish")
    name = "curata_publish_" + os.path.basename(root).split("-")[-1]
    p1 = sinks.publish_snapshot(spark, spark.range(3), name, root)
    assert spark.table(name).count() == 3
    p2 = sinks.publish_snapshot(spark, spark.table(name).union(spark.range(10, 12)), name, root)
    assert p1 != p2
    assert spark.table(name).count() == 5
    assert spark.read.parquet(p1).count() == 3        # old snapshot untouched


def test_create_empty_scd1_table(spark):
    df = files.read_parquet(spark, "/root/testdata/sf0.001/region.parquet", options={})
    name = "curata_empty_" + os.path.basename(scratch_path(spark, "x")).split("-")[-1]
    sinks.create_empty_table(spark, df, name, scd_type=1, location=scratch_path(spark, "ext"))
    assert "is_current" not in spark.table(name).columns and spark.table(name).count() == 0


def test_fanout_and_read_back(spark):
    root = scratch_path(spark, "fan")
    sinks.fanout(spark.range(4), [{"mode": "overwrite", "path": f"{root}/a"},
                                  {"mode": "overwrite", "format": "orc", "path": f"{root}/b"}])
    assert spark.read.parquet(f"{root}/a").count() == 4 and spark.read.orc(f"{root}/b").count() == 4


def test_control_row_missing(spark):
    ctl = spark.createDataFrame([("s", "t")], "schema_name string, table_name string")
    assert control.control_row(ctl, "s", "t")["table_name"] == "t"
    with pytest.raises(LookupError):
        control.control_row(ctl, "s", "missing")


def test_jdbc_round_trip_embedded_derby(spark):
    url = "jdbc:derby:memory:curata_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, NAME string")
    jdbc.write_jdbc(df, url, "AUDIT_T", props, mode="overwrite")
    jdbc.write_jdbc(df, url, "AUDIT_T", props)
    assert jdbc.read_jdbc(spark, url, "AUDIT_T", props).count() == 4
    agg = jdbc.read_jdbc_query(spark, url, 'SELECT MAX("ID") AS M FROM AUDIT_T', props)
    assert agg.first()["M"] == 2


def test_materialize_and_drop_staging(spark):
    from curata.session import checkpoint_root
    df, table = sinks.materialize(spark, spark.range(5), "stage")
    assert df.count() == 5
    folder = os.path.join(checkpoint_root(spark).replace("file:", ""), "curata_staging", table.split(".")[1])
    assert os.path.isdir(folder)
    sinks.drop_staging(spark, table)
    assert not spark.catalog.tableExists(table) and not os.path.exists(folder)


def test_loader_skips_empty_source(spark):
    from curata.plans import loader
    root = scratch_path(spark, "empty-src")
    spark.range(0).write.parquet(root)
    target = spark.range(3)
    cfg = {"source": {"source_table_type": "path", "path": root}, "skip_if_empty": True,
           "load": {"type": "update", "keys": ["id"], "order": ["id"]}}
    assert loader.run_load(spark, cfg, target=target) is target


def test_has_columns(spark):
    from curata.plans import steps
    assert steps.has_columns(spark.range(1), ["ID"]) and not steps.has_columns(spark.range(1), ["x"])


def test_bucketed_snapshot_merge_does_not_shuffle_target(spark):
    from pyspark.sql import functions as F
    from curata.operators import scd
    root = scratch_path(spark, "bucketed")
    name = "curata_bkt_" + os.path.basename(root).split("-")[-1]
    tgt = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sinks.publish_snapshot(spark, tgt, name, root, bucket_by=(4, ["k"]))
    batch = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        merged = scd.scd1(spark.table(name), batch, ["k"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1      # the batch side only
        sinks.publish_snapshot(spark, merged, name, root, bucket_by=(4, ["k"]))   # reads the old folder, writes a new one
        assert spark.table(name).count() == 1010
        assert spark.table(name).where("v = -1").count() == 20
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_append_with_new_column_reads_merged(spark):
    from pyspark.sql import functions as F
    path = scratch_path(spark, "evolve")
    sinks.overwrite_write(spark.range(2), path=path)
    sinks.append_write(spark.range(2, 4).withColumn("extra", F.lit("x")), path=path)
    df = files.read(spark, "parquet", path, {"mergeSchema": "true"})
    assert set(df.columns) == {"id", "extra"}
    assert rows(df, "id", "extra") == [(0, None), (1, None), (2, "x"), (3, "x")]


def test_latest_file_with_blank_in_path(spark):
    root = scratch_path(spark, "landing zone")
    spark.range(3).write.parquet(f"{root}/old batch")
    spark.range(5).withColumnRenamed("id", "n").write.parquet(f"{root}/new batch")
    newest = files.read_latest_file(spark, "parquet", root, {"recursiveFileLookup": "true"})
    assert newest.columns == ["n"]


def test_publish_compacts_by_key(spark):
    import glob
    root = scratch_path(spark, "compact")
    name = "curata_compact_" + os.path.basename(root).split("-")[-1]
    path = sinks.publish_snapshot(spark, spark.range(1000).repartition(20), name, root, repartition_by=(3, ["id"]))
    files_ = [f for f in glob.glob(f"{path.replace('file:', '')}/*.parquet")]
    assert len(files_) <= 3 and spark.table(name).count() == 1000
