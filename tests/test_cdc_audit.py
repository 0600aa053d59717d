"""CDC application and audit rows."""

import datetime as dt

from curata.operators import audit, cdc, incremental
from tests.conftest import rows

T = dt.datetime


def test_change_frame_copies_ids(spark):
    ids = ["k"]
    cf = cdc.ChangeFrame(spark.createDataFrame([(1, "insert", T(2020, 1, 1), "a")], "k int, op string, ts timestamp_ntz, v string"), ids)
    cf.ids.append("other")
    assert ids == ["k"]
    assert cf.values == ["v"]


def test_apply_changes_latest_op_wins(spark):
    tgt = spark.createDataFrame([(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 1), "b")], "k int, ts timestamp_ntz, v string")
    chg = spark.createDataFrame([
        (1, "update", T(2021, 1, 1), "a2"), (1, "delete", T(2021, 2, 1), None),
        (2, "delete", T(2021, 1, 1), None), (2, "insert", T(2021, 3, 1), "b2"),
        (3, "insert", T(2021, 1, 1), "c")], "k int, op string, ts timestamp_ntz, v string")
    out = cdc.apply_changes(tgt, cdc.ChangeFrame(chg, ["k"]), ["ts"])
    assert rows(out, "k", "v") == [(2, "b2"), (3, "c")]


def test_reconcile_and_counts(spark):
    a, b = spark.range(5), spark.range(5)
    r = audit.reconcile(a, b, strict=True).first()
    assert r["is_reconciled"] and r["source_count"] == 5
    assert audit.reconcile(a, spark.range(4)).first()["is_reconciled"] is False


def test_watermark_default(spark):
    marks = spark.createDataFrame([], "table_name string, change_date timestamp_ntz")
    got = incremental.read_watermark(marks, {"table_name": "x"}, default="1900-01-01 00:00:00").first()[0]
    assert got == T(1900, 1, 1)


def test_dedupe_counts(spark):
    df = spark.createDataFrame([(1, 1, 2020), (1, 1, 2020), (2, 1, 2020), (1, 1, 2021)], "a int, b int, y int")
    assert rows(audit.dedupe_counts(df, "y", ["a", "b"])) == [(2020, 3, 2), (2021, 1, 1)]
