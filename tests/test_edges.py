"""Cases that once lost rows, changed values or broke with scale."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from curata.functions import hashing
from curata.operators import compare, dedupe, dims, loads, quality, scd
from curata.plans import flows, loader
from curata.session import scratch_path
from curata.sources import sinks
from tests.conftest import rows

T = dt.datetime


def _hdiff(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v double")
    return [r["hdiff"] for r in hashing.hash_keys(df, ["k"]).orderBy("k").collect()]


def test_hash_text_is_exact(spark):
    values = [1e-7, 2e-7, 1e33, -1e33, math.nan, math.inf, -math.inf, None, 0.1, 0.1 + 2 ** -56, 1334.56, 1334.5600000000002]
    assert len(set(_hdiff(spark, values))) == len(values)
    a, b = _hdiff(spark, [0.0, -0.0])
    assert a == b


def test_flags_keep_columns_named_like_helpers(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "k int, _val_x string, _dup string")
    out = quality.flag(df, [{"type": "unique_check", "columns": ["k"]},
                            {"type": "valid_values_check", "columns": ["_val_x"], "values_column": "v",
                             "values_from": spark.createDataFrame([("a",)], "v string")}])
    assert out.columns == ["k", "_val_x", "_dup", "invalid_reasons"]
    assert sum(len(r["invalid_reasons"]) for r in out.collect()) == 2


def test_duplicate_marker_leaves_rows_as_they_are(spark):
    df = spark.createDataFrame([(1, -0.0, {"a": 1}), (1, 0.0, {"a": 1}), (1, 0.0, {"a": 1}), (2, 5.0, {}), (None, 1.0, None), (None, 1.0, None)],
                               "k int, v double, m map<string,int>").repartition(3)
    got = quality.with_duplicate_marker(df, ["k"], ["v"], "again").collect()
    assert sorted((r["k"] or 0, r["again"]) for r in got) == [(0, False), (0, True), (1, False), (1, True), (1, True), (2, False)]
    assert sum(math.copysign(1, r["v"]) < 0 for r in got) == 1


@pytest.mark.parametrize("kind", ["null", "tied", "text"])
def test_hot_keys_are_split_exactly(spark, kind):
    if kind == "null":
        data = [(None, f"{k:05d}", k) for k in range(3000)]
    elif kind == "tied":
        data = [(1, "same", k) for k in range(3000)]
    else:
        data = [(1, (T(2024, 1, 1) + dt.timedelta(seconds=k)).isoformat(), k) for k in range(3000)]
    df = spark.createDataFrame(data + [(7, "z", 1), (7, None, 2)], "k int, s string, tb int")
    opts = {"fraction": 1.0, "partitions": 6}
    assert dedupe.has_hot_key(df, ["k"], **opts)
    cols = ("k", "s", "tb", "end_time", "is_current", "version")
    plain = dedupe.versions_per_key(df, ["k"], "s", ["tb"], skew=False)
    assert rows(dedupe.versions_per_key(df, ["k"], "s", ["tb"], skew=opts), *cols) == rows(plain, *cols)


def test_scd1_keeps_target_only_columns_and_types(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (2 ** 40, "b", "k2")], "k bigint, v string, note string")
    s = spark.createDataFrame([(1, "z")], "k int, v string")
    want = [(1, "z", "keep"), (2 ** 40, "b", "k2")]
    for out in (scd.scd1_full_join(t, s, ["k"]), scd.scd1(t, s, ["k"])):
        assert rows(out, "k", "v", "note") == want
        assert dict(out.dtypes)["k"] == "bigint"


HIST = "k int, v string, start_time timestamp_ntz, end_time timestamp_ntz, is_current int, is_deleted int"


def _hist(spark):
    return spark.createDataFrame([(1, "a", T(2020, 1, 1), T(2020, 2, 1), 0, 0), (1, "b", T(2020, 2, 1), None, 1, 0)], HIST)


def _no_overlap(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["k"], []).append((r["start_time"], r["end_time"] or T(9999, 1, 1)))
    for spans in by.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_scd2_late_rows_fit_in_and_do_not_repeat(spark):
    src = "k int, v string, start_time timestamp_ntz, is_deleted int"
    for day in (T(2019, 6, 1), T(2020, 1, 10)):
        late = spark.createDataFrame([(1, "old", day, 0)], src)
        once = scd.scd2(_hist(spark), late, ["k"], "start_time", compare=["v"])
        twice = scd.scd2(once, late, ["k"], "start_time", compare=["v"])
        assert once.count() == 3 and rows(twice) == rows(once)
        _no_overlap(once)
        v1 = scd.scd2_versions(_hist(spark), late, ["k"], "start_time")
        v2 = scd.scd2_versions(v1, late, ["k"], "start_time")
        assert v1.count() == 3 and rows(v2) == rows(v1)
        _no_overlap(v1)
        assert rows(v1.where("is_current = 1"), "v") == [("b",)]


def test_repeated_source_keys_are_refused(spark):
    src = spark.createDataFrame([(1, "x", T(2021, 1, 1), 0), (1, "y", T(2021, 1, 1), 0)], "k int, v string, start_time timestamp_ntz, is_deleted int")
    with pytest.raises(Exception, match="repeated key"):
        scd.scd2(_hist(spark), src, ["k"], "start_time", compare=["v"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        compare.classify(src.select("k", "v"), _hist(spark).select("k", "v"), ["k"]).collect()


def test_composite_dimension_keys_do_not_collide(spark):
    schema = "id string, a string, b string, w double, valid_from_date timestamp_ntz, valid_through_date timestamp_ntz"
    dim = spark.createDataFrame([("x", "gone", "m", 1.0, T(1900, 1, 1), T(2000, 1, 1))], schema)
    src = spark.createDataFrame([("1", "23", 1.0), ("12", "3", 1.0), ("a", None, 1.0), (None, "a", 1.0), ("gone", "m", 2.0)], "a string, b string, w double")
    staging = dims.scd2_staging(src, dim, ["a", "b"], ["w"])
    out = dims.scd2_apply(dim, staging, ["a", "b"], "2002-01-01 00:00:00", "id")
    assert out.count() == 5 and out.select("id").distinct().count() == 5
    assert out.where("a = 'gone'").count() == 1                       # only closed rows: not a new member
    staged = dims.staged_load(src, dim, ["a", "b"], ["w"], "2002-01-01 00:00:00", "id", "p_")
    back = staged.where("a = 'gone'").first()
    assert back["load_type"] == "N" and back["valid_from_date"] == T(2000, 1, 1)


def test_several_tracked_attributes(spark):
    schema = "id string, k int, w double, g double, valid_from_date timestamp_ntz, valid_through_date timestamp_ntz"
    dim = spark.createDataFrame([(str(k), k, 1.0, 1.0, T(1900, 1, 1), T(9999, 12, 31)) for k in range(4)], schema)
    src = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 1.0), (2, 1.0, 2.0), (3, None, 1.0)], "k int, w double, g double")
    staged = dims.scd2_staging(src, dim, ["k"], ["w", "g"])
    assert rows(staged.where("stage = 'close'"), "k") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("bucket", [None, (3, ["id"])])
def test_partitioned_snapshots_read_back(spark, bucket):
    root = scratch_path(spark, "parts")
    name = "curata_parts_" + root.rsplit("-", 1)[-1]
    one = spark.range(10).withColumn("is_current", (F.col("id") % 2).cast("int"))
    sinks.publish_snapshot(spark, one, name, root, partition_by=["is_current"], bucket_by=bucket)
    assert spark.table(name).count() == 10
    more = spark.table(name).unionByName(spark.range(10, 20).withColumn("is_current", F.lit(2)))
    sinks.publish_snapshot(spark, more, name, root, partition_by=["is_current"], bucket_by=bucket)
    assert rows(spark.table(name), "id") == [(i,) for i in range(20)]


def test_append_keeps_every_row_and_history_flags(spark):
    batch = spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "b", T(2020, 2, 1))], "k int, v string, ts timestamp_ntz")
    new, obs = flows.landing_to_raw(None, batch, ["k"], ["ts"], load_type="append")
    assert new.count() == 2 and obs["raw"].get["rows"] == 2
    h1 = flows.landing_history(None, batch, ["k"], ["ts"])
    nxt = spark.createDataFrame([(1, "c", T(2020, 3, 1)), (2, "n", T(2020, 3, 1))], batch.schema)
    h2 = flows.landing_history(h1, nxt, ["k"], ["ts"])
    assert rows(h2, "k", "v", "curr_row_flg") == [(1, "b", "N"), (1, "c", "Y"), (2, "n", "Y")]
    h3 = flows.landing_history(h2, nxt.where("k = 1"), ["k"], ["ts"])
    assert rows(h3, "k", "v", "curr_row_flg") == [(1, "b", "N"), (1, "c", "Y"), (2, "n", "D")]


def test_diff_rows_keeps_rows_of_one_side(spark):
    s = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    t = spark.createDataFrame([(2, "x"), (3, None)], "k int, v string")
    assert rows(compare.diff_rows(s, t, ["k"]), "k") == [(1,), (3,)]
    assert rows(compare.diff_rows(s.select("k"), t.select("k"), ["k"]), "k") == [(1,), (3,)]


def test_load_types(spark):
    b = spark.createDataFrame([(1, "a", T(2020, 1, 1)), (1, "b", T(2020, 2, 1)), (2, "x", T(2020, 1, 1))], "k int, v string, ts timestamp_ntz")
    first = loads.apply_load("full_compare", None, b, ["k"], ["ts"])
    nxt = spark.createDataFrame([(1, "c", T(2020, 3, 1))], b.schema)
    out = loads.apply_load("full_compare", first, nxt, ["k"], ["ts"], as_of="2021-01-01 00:00:00")
    assert rows(out, "k", "v", "is_current", "is_deleted") == [(1, "b", 0, 0), (1, "c", 1, 0), (2, "x", 0, 1)]
    h = loads.apply_load("scd2", loads.apply_load("scd2", None, b, ["k"], ["ts"]), nxt, ["k"], ["ts"])
    assert rows(h.where("k = 1"), "v", "is_current") == [("a", 0), ("b", 0), ("c", 1)]
    with pytest.raises(ValueError):
        loads.apply_load("other", None, b, ["k"], ["ts"])


def test_value_lists_with_commas_and_catalog_types(spark, sf):
    from curata.workload.q_loads import catalog_rules
    rules = {r["rule_type"]: r for r in catalog_rules(spark, sf)}
    assert len(rules) == 9
    df = spark.createDataFrame([("6-LOW, LATER",), ("6-LOW",), (None,)], "o_orderpriority string")
    got = quality.flag_rules(df, [rules["valid_values_check"]])
    assert rows(got, "o_orderpriority", "data_quality_valid_flag") == [(None, "Y"), ("6-LOW", "N"), ("6-LOW, LATER", "Y")]


def test_quarantine_appends_and_several_targets(spark, tmp_path):
    from curata.__main__ import main
    root = scratch_path(spark, "quarantine")
    src = f"{root}/src"
    spark.createDataFrame([(1, "a"), (2, None)], "k int, s string").write.parquet(src)
    name = "curata_q_" + root.rsplit("-", 1)[-1]
    cfg = {"source": {"source_table_type": "path", "path": src}, "dq": {"active": [{"type": "null_check", "columns": ["s"]}]},
           "load": {"type": "complete", "keys": ["k"], "order": ["s"]},
           "target": {"table": name, "root": root}, "quarantine": {"table": name + "_bad", "root": root}}
    p = tmp_path / "load.json"
    p.write_text(json.dumps(cfg))
    main([str(p)], spark=spark)
    main([str(p)], spark=spark)
    assert spark.table(name).count() == 1 and spark.table(name + "_bad").count() == 2
    got = loader.run_targets(spark, {"source": cfg["source"], "targets": {"x": cfg["load"], "y": {**cfg["load"], "type": "append"}}}, {})
    assert got["x"].count() == 2 and got["y"].count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from curata import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_scale_settings_grow_with_the_input():
    from curata.session import scale_settings
    parts = [int(scale_settings(n << 40)["spark.sql.shuffle.partitions"]) for n in (1, 10, 100)]
    assert parts[1] > 9 * parts[0] and parts[2] > 9 * parts[1]
