"""End-to-end flows: landing -> raw with observed counts, raw -> curated."""

import datetime as dt

from pyspark.sql import functions as F

from curata.operators import dims
from curata.plans import flows
from curata.workload.inputs import AS_OF, dim_part, src_part
from tests.conftest import rows

T = dt.datetime


def test_landing_to_raw_counts_and_upsert(spark):
    batch = spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "b", T(2020, 2, 1)), (2, "c", T(2020, 1, 1))],
                                  "k int, v string, ts timestamp_ntz")
    new, obs = flows.landing_to_raw(None, batch, ["k"], ["ts"],
                                    rules=[{"id": 1, "rule_dim_id": 9, "rule_type": "valid_values_check",
                                            "column": "v", "valid_values": ["a", "b"]}])
    got = rows(new, "k", "v", "data_quality_valid_flag")
    assert got == [(1, "b", "Y"), (2, "c", "N")]
    assert obs["raw"].get["rows"] == 3 and obs["dedup"].get["rows"] == 2
    again, _ = flows.landing_to_raw(new, batch.where("k = 2"), ["k"], ["ts"],
                                    rules=[{"id": 1, "rule_dim_id": 9, "rule_type": "valid_values_check",
                                            "column": "v", "valid_values": ["a", "b"]}])
    assert rows(again, "k", "v") == [(1, "b"), (2, "c")]


def test_raw_to_curated_matches_operators_and_is_idempotent(spark, sf):
    dim, src = dim_part(spark, sf), src_part(spark, sf)
    keys, tracked, attrs = ["p_partkey"], ["p_retailprice"], ["p_name", "p_brand", "p_type", "p_size"]
    out, mark = flows.raw_to_curated(dim, src.withColumn("change_date", F.lit(T(2001, 6, 1)).cast("timestamp_ntz")),
                                     keys, tracked, attrs, AS_OF, "part_dim_id", "v2_", {"source_system": "erp"},
                                     change_col="change_date", window=("2001-01-01 00:00:00", AS_OF),
                                     watermark_ids={"table_name": "part_dim"})
    staging = dims.scd2_staging(src, dim, keys, tracked)
    expect = dims.scd1_apply(dims.scd2_apply(dim, staging, keys, AS_OF, "part_dim_id", "v2_",
                                             {"source_system": "erp"}), src, keys, tracked, attrs)
    assert rows(out) == rows(expect)
    assert mark.first()["change_date"] == T(2001, 6, 1)
    # at most one open row per member, and a second run changes nothing
    open_rows = out.where("valid_through_date = TIMESTAMP_NTZ '9999-12-31 00:00:00'")
    assert open_rows.groupBy("p_partkey").count().where("count > 1").count() == 0
    out2, _ = flows.raw_to_curated(out, src, keys, tracked, attrs, AS_OF, "part_dim_id", "v2_",
                                   {"source_system": "erp"}, checkpoint_staging=True)
    assert rows(out2) == rows(out)


def test_late_members_rerun_is_noop(spark, sf):
    from curata.operators import late
    from curata.workload.inputs import table
    dim = dim_part(spark, sf)
    fact = table(spark, sf, "lineitem")
    window = ("1995-01-01 00:00:00", AS_OF)
    first = late.late_members(fact, dim, "l_partkey", "l_shipdate", "p_partkey", AS_OF, ["p_name"],
                              id_col="part_dim_id", fixed={"source_system": "erp"}, window=window)
    assert first.count() > 0
    grown = dim.unionByName(first, allowMissingColumns=True)
    again = late.late_members(fact, grown, "l_partkey", "l_shipdate", "p_partkey", AS_OF, ["p_name"],
                              id_col="part_dim_id", fixed={"source_system": "erp"}, window=window)
    assert again.count() == 0


def test_config_load_blocks_active_failures(spark):
    from curata.plans import loader
    from curata.session import scratch_path
    path = scratch_path(spark, "cfg-src")
    spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "z#")], "k int, s string, t string") \
        .write.parquet(path)
    cfg = {"source": {"source_table_type": "path", "path": path},
           "steps": [{"op": "where", "expr": "k > 0"}],
           "dq": {"active": [{"type": "null_check", "columns": ["s"]}],
                  "passive": [{"type": "special_character_check", "columns": ["t"]}]},
           "load": {"type": "complete", "keys": ["k"], "order": ["k"]}}
    new, info = loader.run_config_load(spark, cfg)
    assert rows(new, "k", "passive_reason") == [(1, None), (3, "special_character_check:t")]
    assert info["source_rows"].get["rows"] == 3 and info["loaded_rows"].get["rows"] == 2
    assert rows(info["invalid"], "k", "active_reason") == [(2, "null_check:s")]
    assert info["steps"] == ["0:where"]


def test_command_line_load_publishes_and_counts(spark, tmp_path):
    import json
    from curata.__main__ import main
    from curata.session import scratch_path
    src = scratch_path(spark, "cli-src")
    spark.createDataFrame([(1, "a"), (2, None), (1, "b")], "k int, s string").write.parquet(src)
    root = scratch_path(spark, "cli-root")
    cfg = {"source": {"source_table_type": "path", "path": src},
           "dq": {"active": [{"type": "null_check", "columns": ["s"]}]},
           "load": {"type": "update", "keys": ["k"], "order": ["s"]},
           "target": {"table": "curata_cli_target", "root": root, "bucket_by": [4, ["k"]]},
           "quarantine": {"table": "curata_cli_invalid", "root": root},
           "audit": {"url": "jdbc:derby:memory:curata_cli;create=true", "table": "AUDIT_FACT",
                     "properties": {"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
                     "as_of": "2002-01-01 00:00:00", "sla_dim_id": 7, "audit_dim_id": 42}}
    p = tmp_path / "load.json"
    p.write_text(json.dumps(cfg))
    out = main([str(p)], spark=spark)
    assert rows(spark.table("curata_cli_target"), "k", "s") == [(1, "b")]
    assert spark.table("curata_cli_invalid").count() == 1
    assert out["source_rows"] == 3 and out["loaded_rows"] == 2
    from curata.sources import jdbc
    audit = jdbc.read_jdbc(spark, cfg["audit"]["url"], "AUDIT_FACT", cfg["audit"]["properties"])
    got = {r["audit_record_type_desc"]: r["audit_value"] for r in audit.collect()}
    assert got == {"source_row_count": 3, "loaded_row_count": 2, "invalid_row_count": 1}


def test_staged_load_invariants(spark, sf):
    dim, src = dim_part(spark, sf), src_part(spark, sf)
    staged = dims.staged_load(src, dim, ["p_partkey"], ["p_retailprice"], AS_OF, "part_dim_id", "part_",
                              fixed={"source_system": "erp"})
    by = {t: {r["p_partkey"] for r in staged.where(F.col("load_type") == t).select("p_partkey").collect()}
          for t in ("U2", "N2", "N", "U1")}
    opened, _ = dims.open_rows(dim)
    open_keys = {r["p_partkey"] for r in opened.select("p_partkey").collect()}
    src_keys = {r["p_partkey"] for r in src.select("p_partkey").collect()}
    assert by["U2"] == by["N2"]                                  # every close has its new version
    assert by["U2"] | by["U1"] == open_keys & src_keys and not (by["U2"] & by["U1"])
    assert by["N"] == src_keys - open_keys
    assert staged.groupBy("part_dim_id", "load_type").count().where("count > 1").count() == 0


def test_raw_to_curated_dedupes_the_increment(spark, sf):
    dim, src = dim_part(spark, sf), src_part(spark, sf)
    raw = (src.withColumn("change_date", F.lit(T(2001, 6, 1)).cast("timestamp_ntz"))
           .unionByName(src.withColumn("p_retailprice", F.col("p_retailprice") + 1)
                        .withColumn("change_date", F.lit(T(2001, 7, 1)).cast("timestamp_ntz"))))
    out, _ = flows.raw_to_curated(dim, raw, ["p_partkey"], ["p_retailprice"], ["p_name"], AS_OF,
                                  "part_dim_id", "v2_", {"source_system": "erp"}, change_col="change_date")
    open_rows = out.where("valid_through_date = TIMESTAMP_NTZ '9999-12-31 00:00:00'")
    assert open_rows.groupBy("p_partkey").count().where("count > 1").count() == 0
    joined = open_rows.join(src.select("p_partkey", F.col("p_retailprice").alias("sp")), "p_partkey")
    assert joined.where("abs(p_retailprice - (sp + 1)) > 1e-9").count() == 0   # the newer change won


def test_example_config_runs(spark):
    import os
    from curata.__main__ import main
    ex = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples",
                      "orders_latest_by_customer.json")
    out = main([ex], spark=spark)
    t = spark.table("curated_orders_by_customer")
    assert out["loaded_rows"] == out["source_rows"] and t.count() == t.select("customer_id").distinct().count()
