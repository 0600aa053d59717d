"""Micro-batch loads: stream result equals batch result; replay is idempotent."""

import datetime as dt

from pyspark.sql import functions as F

from curata.operators import dedupe, scd
from curata.session import scratch_path
from curata.streaming import sinks as ss
from curata.streaming.sources import stream
from tests.conftest import rows

T = dt.datetime
SCHEMA = "k int, v string, ts timestamp_ntz"


def _land(spark, root, batches):
    """Each batch written as its own landing file, oldest first."""
    for i, data in enumerate(batches):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/landing/b{i}")


B = [[(1, "a", T(2020, 1, 1)), (2, "b", T(2020, 1, 1))],
     [(1, "a2", T(2020, 2, 1)), (3, "c", T(2020, 2, 1))],
     [(2, "b2", T(2020, 3, 1)), (1, "a3", T(2020, 3, 1))]]


def _run(spark, root, load):
    s = stream(spark, "parquet", f"{root}/landing", {"recursiveFileLookup": "true", "maxFilesPerTrigger": 1})
    q = ss.for_each_batch(s, ss.snapshot_loader(spark, f"{root}/out", load), f"{root}/_ck")
    return q, spark.read.parquet(ss.batch_path(f"{root}/out", ss.last_batch(q)))


def test_stream_scd1_equals_batch(spark):
    root = scratch_path(spark, "t-s1")
    _land(spark, root, B)
    q, out = _run(spark, root, lambda t, b: scd.scd1_latest(t, b, ["k"], ["ts"]))
    assert ss.last_batch(q) == 2
    batch = dedupe.latest_per_key(spark.createDataFrame([r for b in B for r in b], SCHEMA), ["k"], ["ts"])
    assert rows(out) == rows(batch)


def test_stream_scd2_first_then_later_batches(spark):
    root = scratch_path(spark, "t-s2")
    _land(spark, root, B)

    def load(t, b):
        b = b.withColumns({"start_time": F.col("ts"), "is_deleted": F.lit(0)})
        if t is None:
            return scd.scd2_first_load(b, ["k"], "start_time")
        return scd.scd2_versions(t, b, ["k"], "start_time")
    _, out = _run(spark, root, load)
    assert out.count() == 6
    assert rows(out.where("is_current = 1"), "k", "v") == [(1, "a3"), (2, "b2"), (3, "c")]


def test_replayed_batch_is_idempotent(spark):
    root = scratch_path(spark, "t-replay")
    out = f"{root}/out"
    fn = ss.snapshot_loader(spark, out, lambda t, b: scd.scd1_latest(t, b, ["k"], ["ts"]))
    b0 = spark.createDataFrame(B[0], SCHEMA)
    b1 = spark.createDataFrame(B[1], SCHEMA)
    fn(b0, 0)
    fn(b1, 1)
    first = rows(spark.read.parquet(ss.batch_path(out, 1)))
    fn(b1, 1)                                   # replay after a failure
    assert rows(spark.read.parquet(ss.batch_path(out, 1))) == first


def test_stream_source_type_check(spark):
    import pytest
    with pytest.raises(ValueError):
        stream(spark, "kafka-ish", "/nowhere")


def test_bucketed_snapshots_equal_plain_and_survive_catalog_loss(spark):
    import os
    root = scratch_path(spark, "t-bkt")
    _land(spark, root, B)
    prefix = "curata_stream_" + os.path.basename(root).split("-")[-1]
    s = stream(spark, "parquet", f"{root}/landing", {"recursiveFileLookup": "true", "maxFilesPerTrigger": 1})
    fn = ss.snapshot_loader(spark, f"{root}/out", lambda t, b: scd.scd1_latest(t, b, ["k"], ["ts"]),
                            bucket_by=(4, ["k"]), table_prefix=prefix)
    q = ss.for_each_batch(s, fn, f"{root}/_ck")
    last = ss.last_batch(q)
    assert rows(spark.table(f"{prefix}_b{last}")) == rows(
        dedupe.latest_per_key(spark.createDataFrame([r for b in B for r in b], SCHEMA), ["k"], ["ts"]))
    before = rows(spark.table(f"{prefix}_b{last}"))
    # the catalog forgets the previous snapshot (external table: files stay);
    # replaying the last batch re-registers it, bucket spec included
    spark.sql(f"DROP TABLE {prefix}_b{last - 1}")
    fn(spark.createDataFrame(B[last], SCHEMA), last)
    assert rows(spark.table(f"{prefix}_b{last}")) == before
    desc = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {prefix}_b{last - 1}").collect()}
    assert desc.get("Num Buckets") == "4"


def test_csv_landing_stream_and_headerless_positional_names(spark):
    from curata.plans import steps
    from curata.sources import files
    root = scratch_path(spark, "t-csv")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    df.coalesce(1).write.option("header", "true").csv(f"{root}/landing/h")
    s = stream(spark, "csv", f"{root}/landing", {"header": "true", "recursiveFileLookup": "true",
                                                 "pathGlobFilter": "*.csv", "maxFilesPerTrigger": 1})
    ss.append(s, f"{root}/out", f"{root}/_ck")
    assert rows(spark.read.parquet(f"{root}/out"), "id", "name") == [("1", "a"), ("2", "b"), ("3", "c")]
    # headerless landing file: names come from the mapping order
    df.coalesce(1).write.csv(f"{root}/raw")
    raw = files.read_csv(spark, f"{root}/raw")
    named = steps.positional_names(raw, ["customer_id", "customer_name"])
    assert rows(named) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_stream_schema_from_newest_file(spark):
    from pyspark.sql import functions as F
    root = scratch_path(spark, "t-newest")
    spark.range(2).write.parquet(f"{root}/landing/old")
    spark.range(2, 4).withColumn("extra", F.lit("x")).write.parquet(f"{root}/landing/new")
    s = stream(spark, "parquet", f"{root}/landing", {"recursiveFileLookup": "true"}, schema="newest")
    assert s.columns == ["id", "extra"]
    ss.append(s, f"{root}/out", f"{root}/_ck")
    assert rows(spark.read.parquet(f"{root}/out")) == [(0, None), (1, None), (2, "x"), (3, "x")]


def test_cloudfiles_source_maps_to_native_stream(spark):
    root = scratch_path(spark, "t-cf")
    spark.range(5).write.parquet(f"{root}/landing")
    s = stream(spark, "cloudFiles", f"{root}/landing", {"cloudFiles.format": "parquet",
                                                         "cloudFiles.maxFilesPerTrigger": 1,
                                                         "cloudFiles.schemaLocation": "/ignored"})
    ss.append(s, f"{root}/out", f"{root}/_ck")
    assert spark.read.parquet(f"{root}/out").count() == 5


def test_processing_time_trigger(spark):
    root = scratch_path(spark, "t-trig")
    spark.range(7).write.parquet(f"{root}/landing")
    s = stream(spark, "parquet", f"{root}/landing")
    q = ss.append(s, f"{root}/out", f"{root}/_ck", query_name=None, trigger="1 second", wait=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{root}/out").count() == 7


def test_configured_stream_load_reruns_checks_and_counts(spark):
    from curata.plans import loader
    from curata.streaming.audit import AuditLog
    for kind in ("update", "scd2", "complete", "append"):
        root = scratch_path(spark, "t-cfg-stream")
        _land(spark, root, B[:2])
        cfg = {"source": {"streaming": True, "format": "parquet", "path": f"{root}/landing", "schema": SCHEMA,
                          "options": {"recursiveFileLookup": "true", "maxFilesPerTrigger": 1}},
               "dq": {"active": [{"type": "valid_values_check", "columns": ["v"], "valid_values": ["a", "b", "a2", "a3", "b2"]}]},
               "load": {"type": kind, "keys": ["k"], "order": ["ts"], "buckets": 4}}
        log = AuditLog(spark, f"{root}/audit", "2002-01-01 00:00:00")
        first = rows(loader.run_stream_load(spark, cfg, f"{root}/out", f"{root}/_ck", audit=log), "k", "v")
        want = {"update": [(1, "a2"), (2, "b")], "scd2": [(1, "a"), (1, "a2"), (2, "b")], "complete": [(1, "a2")],
                "append": [(1, "a"), (1, "a2"), (2, "b")]}[kind]
        assert first == want, kind
        # nothing new has landed: the table is still there
        assert rows(loader.run_stream_load(spark, cfg, f"{root}/out", f"{root}/_ck", audit=log), "k", "v") == want
        assert rows(spark.read.parquet(f"{root}/out-invalid"), "k", "v") == [(3, "c")]
        counts = rows(log.rows(), "batch_id", "audit_record_type_desc", "audit_value")
        assert counts == [(0, "batch.rows", 2), (0, "source.invalid", 0), (0, "source.rows", 2),
                          (1, "batch.rows", 1), (1, "source.invalid", 1), (1, "source.rows", 2)], kind


def test_stream_load_before_the_first_batch(spark):
    from curata.plans import loader
    root = scratch_path(spark, "t-cfg-empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/landing")
    cfg = {"source": {"streaming": True, "format": "parquet", "path": f"{root}/landing", "schema": SCHEMA},
           "load": {"type": "update", "keys": ["k"], "order": ["ts"]}}
    initial = spark.createDataFrame(B[0], SCHEMA)
    assert rows(loader.run_stream_load(spark, cfg, f"{root}/out", f"{root}/_ck", initial)) == rows(initial)
    assert loader.run_stream_load(spark, cfg, f"{root}/out2", f"{root}/_ck2") is None


def test_table_sink_refuses_what_it_cannot_merge(spark):
    import pytest
    root = scratch_path(spark, "t-table")
    name = "curata_t_" + root.rsplit("-", 1)[-1]
    read = {"recursiveFileLookup": "true"}
    spark.range(3).write.parquet(f"{root}/in/a")
    ss.append_table(stream(spark, "parquet", f"{root}/in", read), name, f"{root}/_ck")
    spark.range(3, 5).withColumn("extra", F.lit("x")).write.parquet(f"{root}/in/b")
    grown = stream(spark, "parquet", f"{root}/in", read, schema="id long, extra string")
    with pytest.raises(ValueError):
        ss.append_table(grown, name, f"{root}/_ck")
    with pytest.raises(ValueError):
        ss.append_table(grown.withColumn("id", F.col("id").cast("string")), name, f"{root}/_ck", merge_schema=True)
    ss.append_table(grown, name, f"{root}/_ck", merge_schema=True)
    assert rows(spark.table(name)) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x")]
