"""Bucketed streaming tables: only reached buckets are rewritten, replays change nothing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from curata.operators import dedupe, scd
from curata.session import scratch_path
from curata.streaming.buckets import BucketedTable
from tests.conftest import rows

T = dt.datetime
SCHEMA = "k int, v string, ts timestamp_ntz"
OPEN = "is_current = 1 AND is_deleted = 0"


def _type1(target, batch):
    return scd.scd1_latest(target, batch, ["k"], ["ts"])


def _type2(target, batch):
    b = batch.withColumns({"start_time": F.col("ts"), "is_deleted": F.lit(0)})
    if target is None:
        return scd.scd2_first_load(b, ["k"], "start_time")
    return scd.scd2_versions(target, b, ["k"], "start_time", skew=False)


def _files(root):
    """{path: modification time} of the data files."""
    out = {}
    for d, _, names in os.walk(root):
        out.update({f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for n in names if n.startswith("part-")})
    return out


def _batches(n_keys=40):
    day = [T(2020, m, 1) for m in (1, 2, 3, 4)]
    return [[(k, "a", day[0]) for k in range(n_keys)], [(1, "b", day[1]), (7, "b", day[1])], [(7, "c", day[2]), (99, "n", day[2])]]


def _frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_untouched_buckets_keep_their_files(spark):
    root = scratch_path(spark, "t-buckets")
    table = BucketedTable(spark, root, ["k"], buckets=16, keep=5)
    seen = []
    for i, data in enumerate(_batches()):
        table.merge(_frame(spark, data), i, _type1)
        seen.append(_files(root))
    for i, (a, b) in enumerate(zip(seen, seen[1:]), start=1):
        assert a.items() <= b.items()                                # nothing was rewritten in place
        new = {p.split("_bucket=")[1].split("/")[0] for p in b.keys() - a.keys()}
        keys = {k for k, _, _ in _batches()[i]}
        touched = _frame(spark, _batches()[i]).select(table._bucket(None)).distinct().count()
        assert len(new) == touched <= len(keys)
    every = _frame(spark, [r for b in _batches() for r in b])
    assert rows(table.read()) == rows(dedupe.latest_per_key(every, ["k"], ["ts"]))
    # earlier states stay readable as long as their manifests are kept
    assert rows(table.read(0)) == rows(_frame(spark, _batches()[0]))


def test_replayed_batch_changes_nothing(spark):
    root = scratch_path(spark, "t-buckets")
    table = BucketedTable(spark, root, ["k"], buckets=8, open_when=OPEN, start="start_time", batch_start="ts")
    for i, data in enumerate(_batches()):
        table.merge(_frame(spark, data), i, _type2)
    first = rows(table.read())
    assert table.merge(_frame(spark, _batches()[2]), 2, _type2) == {"batch": {"rows": 2}}
    assert rows(table.read()) == first and table.versions() == [1, 2]
    assert table.merge(_frame(spark, []), 3, _type2) == {} and rows(table.read()) == first


def test_type2_history_is_added_to_not_rewritten(spark):
    root = scratch_path(spark, "t-buckets")
    table = BucketedTable(spark, root, ["k"], buckets=8, open_when=OPEN, start="start_time", batch_start="ts", keep=5)
    read = []

    def load(target, batch):
        read.append(None if target is None else target.where(f"NOT ({OPEN})").count())
        return _type2(target, batch)
    for i, data in enumerate(_batches()):
        table.merge(_frame(spark, data), i, load)
    assert read == [None, 0, 0]                                      # closed rows were never read back
    late = [(7, "late", T(2020, 2, 15))]
    table.merge(_frame(spark, late), 3, load)
    assert read[3] == 2                                              # but for the bucket of a late row
    everything = _frame(spark, [r for b in [*_batches(), late] for r in b])
    want = scd.scd2_first_load(everything.withColumns({"start_time": F.col("ts"), "is_deleted": F.lit(0)}), ["k"], "start_time")
    cols = ("k", "v", "start_time", "end_time", "is_current")
    assert rows(table.read(), *cols) == rows(want, *cols)
    assert rows(table.read(state="open"), *cols) == rows(want.where(OPEN), *cols)


def test_retention_and_compaction(spark):
    root = scratch_path(spark, "t-buckets")
    table = BucketedTable(spark, root, ["k"], buckets=2, open_when=OPEN, start="start_time", batch_start="ts", keep=2, compact_after=3)
    every = []
    for i in range(7):
        data = [(k, f"v{i}", T(2020, 1, 1 + i)) for k in range(6)]
        every += data
        table.merge(_frame(spark, data), i, _type2)
    assert table.versions() == [5, 6]
    named = table._files(table.manifest(5)) | table._files(table.manifest(6))
    on_disk = {(int(p.split("/v=")[1].split("/")[0]), p.split("_state=")[1].split("/")[0], int(p.split("_bucket=")[1].split("/")[0]))
               for p in _files(root)}
    assert on_disk == named
    assert max(len(v) for v in table.manifest(6)["closed"].values()) <= 3
    assert table.read().count() == len(every) and table.read().where(OPEN).count() == 6


def test_columns_of_later_batches_and_emptied_buckets(spark):
    root = scratch_path(spark, "t-buckets")
    table = BucketedTable(spark, root, ["k"], buckets=4)
    table.seed(_frame(spark, [(k, "a", T(2020, 1, 1)) for k in range(8)]))
    with pytest.raises(ValueError):
        table.seed(_frame(spark, []))
    more = _frame(spark, [(1, "b", T(2020, 2, 1)), (None, "n", T(2020, 2, 1))]).withColumn("extra", F.lit(5))
    table.merge(more, 0, _type1)
    assert rows(table.read(), "k", "extra") == [(None, 5), (0, None), (1, 5), *[(k, None) for k in range(2, 8)]]
    table.merge(_frame(spark, [(k, "x", T(2020, 3, 1)) for k in range(8)]), 1, lambda t, b: t.join(b, "k", "left_anti"))
    assert rows(table.read(), "k") == [(None,)]
    with pytest.raises(ValueError):
        BucketedTable(spark, root, ["k"], keep=1)
