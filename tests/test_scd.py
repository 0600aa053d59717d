"""SCD invariants and the reference defects we do not reproduce."""

import datetime as dt

from pyspark.sql import functions as F

from curata.operators import dedupe, loads, scd
from tests.conftest import rows

T = dt.datetime
SCHEMA = "k int, v string, start_time timestamp_ntz, end_time timestamp_ntz, is_current int, is_deleted int"


def _hist(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _src(spark, data):
    return spark.createDataFrame(data, "k int, v string, start_time timestamp_ntz")


def _open_per_key(df):
    return {r["k"]: r["n"] for r in df.where("is_current = 1").groupBy("k").agg(F.count("*").alias("n")).collect()}


def test_scd2_closes_only_open_rows(spark):
    hist = _hist(spark, [(1, "a", T(2020, 1, 1), T(2021, 1, 1), 0, 0),
                         (1, "b", T(2021, 1, 1), None, 1, 0)])
    out = scd.scd2(hist, _src(spark, [(1, "c", T(2022, 1, 1))]), ["k"], "start_time")
    got = rows(out, "v", "end_time", "is_current")
    assert got == [("a", T(2021, 1, 1), 0), ("b", T(2022, 1, 1), 0), ("c", None, 1)]


def test_scd2_skip_unchanged_and_reproduce(spark):
    hist = _hist(spark, [(1, "a", T(2020, 1, 1), None, 1, 0)])
    same = _src(spark, [(1, "a", T(2022, 1, 1))])
    assert scd.scd2(hist, same, ["k"], "start_time", compare=["v"]).count() == 1
    assert scd.scd2(hist, same, ["k"], "start_time", compare=["v"], skip_unchanged=False).count() == 2


def test_scd2_second_identical_load_is_noop(spark):
    hist = _hist(spark, [(1, "a", T(2020, 1, 1), None, 1, 0), (2, "x", T(2020, 1, 1), None, 1, 0)])
    src = _src(spark, [(1, "b", T(2022, 1, 1)), (3, "n", T(2022, 1, 1))])
    once = scd.scd2(hist, src, ["k"], "start_time", compare=["v"])
    twice = scd.scd2(once, src, ["k"], "start_time", compare=["v"])
    assert rows(once) == rows(twice)
    assert all(n == 1 for n in _open_per_key(twice).values())


def test_scd2_out_of_order_row_inserted_closed(spark):
    hist = _hist(spark, [(1, "b", T(2021, 1, 1), None, 1, 0)])
    out = scd.scd2(hist, _src(spark, [(1, "old", T(2020, 1, 1))]), ["k"], "start_time", compare=["v"])
    assert rows(out, "v", "end_time", "is_current") == [("b", None, 1), ("old", T(2021, 1, 1), 0)]


def test_scd2_versions_intervals_do_not_overlap(spark):
    hist = _hist(spark, [(1, "a", T(2020, 1, 1), None, 1, 0)])
    src = _src(spark, [(1, "b", T(2021, 3, 1)), (1, "c", T(2021, 1, 1)), (2, "z", T(2021, 2, 1))])
    out = scd.scd2_versions(hist, src, ["k"], "start_time")
    assert _open_per_key(out) == {1: 1, 2: 1}
    k1 = sorted((r["start_time"], r["end_time"]) for r in out.where("k = 1").collect())
    for (s1, e1), (s2, _) in zip(k1, k1[1:]):
        assert e1 == s2 and s1 < s2
    assert k1[-1][1] is None


def test_scd2_full_compare_soft_delete(spark):
    tgt = _hist(spark, [(1, "a", T(2020, 1, 1), None, 1, 0), (2, "b", T(2020, 1, 1), None, 1, 0)])
    snap = spark.createDataFrame([(1, "a2", T(2021, 1, 1)), (3, "c", T(2021, 1, 1))], "k int, v string, d timestamp_ntz")
    out = scd.scd2_full_compare(tgt, snap.drop("d").withColumn("d", F.lit(T(2021, 1, 1)).cast("timestamp_ntz")),
                                ["k"], [F.col("d")], "2022-01-01 00:00:00", compare=["v"])
    got = {(r["k"], r["v"]): (r["is_current"], r["is_deleted"]) for r in out.collect()}
    assert got[(2, "b")] == (0, 1)
    assert got[(1, "a")] == (0, 0) and got[(1, "a2")] == (1, 0)
    assert got[(3, "c")] == (1, 0)


def test_scd1_counts_updated_plus_inserted_equal_source_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    out = scd.scd1(tgt, src, ["k"], action_col="action")
    acts = dict(rows(out.groupBy("action").count(), "action", "count"))
    assert acts == {"KEEP": 1, "UPDATE": 1, "INSERT": 1}
    assert acts["UPDATE"] + acts["INSERT"] == src.count()


def test_mapped_merge_keeps_unlisted_columns(spark):
    tgt = spark.createDataFrame([(1, "a", "keep")], "k int, v string, note string")
    src = spark.createDataFrame([(1, "A", "x"), (2, "b", "y")], "k int, v string, note string")
    out = scd.scd1(tgt, src, ["k"], update=["v"], insert=["v"])
    assert rows(out) == [(1, "A", "keep"), (2, "b", None)]


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([(1, T(2020, 1, 1), 5), (1, T(2020, 1, 1), 9), (2, T(2019, 1, 1), 1)],
                               "k int, t timestamp_ntz, tb int")
    assert rows(dedupe.latest_per_key(df, ["k"], ["t"], ["tb"])) == [(1, T(2020, 1, 1), 9), (2, T(2019, 1, 1), 1)]


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = dedupe.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "WindowGroupLimit" in plan


def test_load_types(spark):
    tgt = spark.createDataFrame([(1, "a", 1)], "k int, v string, t int")
    batch = spark.createDataFrame([(1, "b", 2), (1, "c", 3), (2, "d", 1)], "k int, v string, t int")
    assert loads.apply_load("append", tgt, batch, ["k"], ["t"]).count() == 4
    assert rows(loads.apply_load("update", tgt, batch, ["k"], ["t"])) == [(1, "c", 3), (2, "d", 1)]
    assert rows(loads.apply_load("complete", tgt, batch, ["k"], ["t"])) == [(1, "c", 3), (2, "d", 1)]
    import pytest
    with pytest.raises(ValueError):
        loads.apply_load("merge-ish", tgt, batch, ["k"], ["t"])


def test_empty_target_and_source(spark):
    tgt = spark.createDataFrame([], "k int, v string")
    src = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(scd.scd1(tgt, src, ["k"])) == [(1, "a")]
    assert scd.scd1(src, tgt, ["k"]).count() == 1


def test_versions_skew_split_matches_plain_window(spark):
    import random
    rnd = random.Random(5)
    data = [(1, T(2020, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 3000)), i) for i in range(4000)]
    data += [(2, T(2021, 1, 1), 1), (2, T(2021, 1, 2), 2), (None, T(2021, 1, 1), 3), (3, T(2022, 1, 1), 4)]
    df = spark.createDataFrame(data, "k int, s timestamp_ntz, tb int")
    plain = dedupe.versions_per_key(df, ["k"], "s", ["tb"], skew=False)
    split = dedupe.versions_per_key(df, ["k"], "s", ["tb"],
                                    skew={"fraction": 1.0, "partitions": 8})
    assert dedupe.has_hot_key(df, ["k"], fraction=1.0, partitions=8)
    assert split.columns == plain.columns
    cols = ("k", "s", "tb", "end_time", "is_current", "version")
    assert rows(split, *cols) == rows(plain, *cols)


def test_scd2_versions_out_of_order_row_slots_into_timeline(spark):
    hist = _hist(spark, [(1, "b", T(2021, 1, 1), None, 1, 0)])
    src = spark.createDataFrame([(1, "a", T(2020, 6, 1), 0), (1, "c", T(2022, 1, 1), 0)],
                                "k int, v string, start_time timestamp_ntz, is_deleted int")
    out = scd.scd2_versions(hist, src, ["k"], "start_time")
    got = rows(out, "v", "start_time", "end_time", "is_current")
    assert got == [("a", T(2020, 6, 1), T(2021, 1, 1), 0), ("b", T(2021, 1, 1), T(2022, 1, 1), 0),
                   ("c", T(2022, 1, 1), None, 1)]


def test_versions_skew_split_composite_key_date_order(spark):
    import random
    rnd = random.Random(11)
    base = dt.date(2020, 1, 1)
    data = [("a", 1, base + dt.timedelta(days=rnd.randint(0, 400)), i) for i in range(3000)]
    data += [("b", 2, base, 1), ("b", 2, base + dt.timedelta(days=1), 2), ("a", 2, base, 3)]
    df = spark.createDataFrame(data, "k1 string, k2 int, d date, tb int")
    opts = {"fraction": 1.0, "partitions": 6}
    assert dedupe.has_hot_key(df, ["k1", "k2"], **opts)
    plain = dedupe.versions_per_key(df, ["k1", "k2"], "d", ["tb"], skew=False)
    split = dedupe.versions_per_key(df, ["k1", "k2"], "d", ["tb"], skew=opts)
    cols = ("k1", "k2", "d", "tb", "end_time", "is_current", "version")
    assert rows(split, *cols) == rows(plain, *cols)


def test_versions_skew_split_string_order(spark):
    import random
    rnd = random.Random(3)
    words = ["", "a", "ab", "abc", "b", "ba", "zz", "é", "éa", "A", "a\u0001", "abcdefg", "abcdefh"]
    data = [(1, rnd.choice(words) + str(rnd.randint(0, 50)), i) for i in range(2000)] + [(2, "x", 1)]
    df = spark.createDataFrame(data, "k int, s string, tb int")
    opts = {"fraction": 1.0, "partitions": 8}
    assert dedupe.has_hot_key(df, ["k"], **opts)
    plain = dedupe.versions_per_key(df, ["k"], "s", ["tb"], end_col="nxt", skew=False)
    split = dedupe.versions_per_key(df, ["k"], "s", ["tb"], end_col="nxt", skew=opts)
    cols = ("k", "s", "tb", "nxt", "is_current", "version")
    assert rows(split, *cols) == rows(plain, *cols)
