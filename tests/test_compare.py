"""Delta detection: null-safe compare, hash encoding, hash delta."""

from pyspark.sql import functions as F

from curata.functions import hashing
from curata.operators import compare
from tests.conftest import rows


def test_null_to_value_is_a_change(spark):
    src = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "k int, a string, b string")
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "b", "z")], "k int, a string, b string")
    got = rows(compare.classify(src, tgt, ["k"]), "k", "action")
    assert got == [(1, "UPDATED"), (2, "UPDATED")]     # second column counts too


def test_classify_all_actions(spark):
    src = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert rows(compare.classify(src, tgt, ["k"]), "k", "action") == [
        (1, "SAME"), (2, "UPDATED"), (3, "DELETED"), (4, "NEW")]


def test_hash_encoding_is_unambiguous(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("ab", "", None)], "x string, y string, z string")
    h = hashing.hash_keys(df.withColumn("k", F.lit(1)), ["k"])
    assert h.select("hdiff").distinct().count() == 3


def test_negative_zero_hashes_like_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -0.0)], "k int, v double")
    assert hashing.hash_keys(df, ["k"]).select("hdiff").distinct().count() == 1


def test_hash_delta_each_key_once(spark):
    e = hashing.hash_keys(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), ["k"])
    i = hashing.hash_keys(spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string"), ["k"])
    got = rows(compare.hash_delta(e, i), "k", "v", "curr_row_flg")
    assert got == [(1, "a", "Y"), (2, "B", "Y"), (2, "b", "N"), (3, "c", "D"), (4, "d", "Y")]


def test_snapshot_history(spark):
    old = hashing.hash_keys(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), ["k"])
    cur = hashing.hash_keys(spark.createDataFrame([(1, "a"), (2, "B")], "k int, v string"), ["k"])
    old = old.withColumn("curr_row_flg", F.lit("Y"))
    cur = cur.withColumn("curr_row_flg", F.lit("Y"))
    assert rows(compare.snapshot_history(old, cur), "k", "curr_row_flg") == [(2, "N"), (3, "D")]


def test_diff_rows_without_target_passes_through(spark):
    src = spark.createDataFrame([(1, "a")], "k int, v string")
    assert compare.diff_rows(src, None, ["k"]).count() == 1
