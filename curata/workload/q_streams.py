"""Query keys: events.parquet as a file stream, loaded with the batch
operators, written to a fresh sink and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe, scd
from ..plans import flows, steps
from ..session import scratch_path
from ..streaming import sinks as ss
from ..streaming.audit import AuditLog, ProgressAudit, observed
from ..streaming.buckets import BucketedTable
from ..streaming.sources import file_name, stream, with_stream_control
from ..constants import ts
from .inputs import AS_OF, table
from .registry import comparable, query
from .sqlgen import md5_of


def _events_stream(spark, d, lineage=False):
    return stream(spark, "parquet", d, {"pathGlobFilter": "events.parquet", "maxFilesPerTrigger": 1},
                  lineage=lineage)


@query("stream_append", f"""
SELECT event_id, ts, user_id, event_type, CAST(CAST(value AS DECIMAL(13,3)) AS DOUBLE) AS value, props, 1 AS is_current, 0 AS is_deleted, TIMESTAMP '{AS_OF}' AS start_time, CAST(NULL AS TIMESTAMP) AS end_time,
  TIMESTAMP '{AS_OF}' AS row_creation_time, 'events.parquet' AS file_name FROM events""")
def stream_append(spark, d):
    root = scratch_path(spark, "stream-append")
    # change log with a typed cast (the cast step works on streams as on batches)
    s, _ = steps.run(_events_stream(spark, d, lineage=True), [{"op": "cast", "types": {"value": "decimal(13,3)"}}])
    s = with_stream_control(file_name(s), AS_OF)
    s = s.drop("file_path", "file_modification_time")
    ss.append(s, f"{root}/out", f"{root}/_checkpoint", query_name=None)
    return comparable(spark.read.parquet(f"{root}/out"), decimals=["value"])


LATEST_USER = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, "
               "event_id DESC) AS rn FROM events) WHERE rn = 1")


WAVES = ["1900-01-01", "2024-01-11", "2024-01-21", "2999-01-01"]       # the events land in three waves, by time


def _waves(spark, d, root):
    """Land the events wave by wave under ``root``; yields after each."""
    e = table(spark, d, "events")
    for a, b in zip(WAVES, WAVES[1:]):
        e.where((F.col("ts") >= ts(f"{a} 00:00:00")) & (F.col("ts") < ts(f"{b} 00:00:00"))).write.mode("append").parquet(f"{root}/landing")
        yield


def _run_batches(spark, d, root, fn, prepare=lambda s: s, output_mode="append"):
    """One micro-batch per wave: each run resumes from the checkpoint of the one before."""
    for _ in _waves(spark, d, root):
        s = prepare(stream(spark, "parquet", f"{root}/landing", {}))
        q = ss.for_each_batch(s, fn, f"{root}/_checkpoint", output_mode=output_mode)
    return q


@query("stream_overwrite", LATEST_USER.replace("FROM events)", f"FROM events WHERE ts >= TIMESTAMP '{WAVES[2]} 00:00:00')"))
def stream_overwrite(spark, d):
    root = scratch_path(spark, "stream-overwrite")
    fn = ss.overwrite_latest(spark, f"{root}/out",
                             lambda b: dedupe.latest_per_key(b, ["user_id"], ["ts"], ["event_id"]))
    _run_batches(spark, d, root, fn)
    return ss.newest_snapshot(spark, f"{root}/out")


@query("stream_scd1", LATEST_USER)
def stream_scd1(spark, d):
    root = scratch_path(spark, "stream-scd1")

    def load(target, batch):
        return scd.scd1_latest(target, batch, ["user_id"], ["ts"], ["event_id"])
    out = BucketedTable(spark, f"{root}/out", ["user_id"], buckets=8)
    _run_batches(spark, d, root, out.loader(load))
    return out.read()


@query("stream_scd2", """
SELECT *, ts AS start_time, 0 AS is_deleted, lead(ts) OVER w AS end_time,
  CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def stream_scd2(spark, d):
    root = scratch_path(spark, "stream-scd2")

    def load(target, batch):
        b = batch.withColumns({"start_time": F.col("ts"), "is_deleted": F.lit(0)})
        if target is None:                       # first batch: every version, newest current
            return scd.scd2_first_load(b, ["user_id"], "start_time", ["event_id"])
        return scd.scd2_versions(target, b, ["user_id"], "start_time", ["event_id"])
    # closed history is added to, never rewritten, as long as no batch reaches back
    out = BucketedTable(spark, f"{root}/out", ["user_id"], buckets=8, open_when="is_current = 1 AND is_deleted = 0",
                        start="start_time", batch_start="ts")
    _run_batches(spark, d, root, out.loader(load))
    return out.read()


RAW_RULES = [
    {"id": 701, "rule_dim_id": 9, "rule_type": "valid_values_check", "column": "event_type",
     "valid_values": ["click", "view", "purchase", "signup"]},
    {"id": 702, "rule_dim_id": 2, "rule_type": "range_check", "column": "value", "operator": "<", "low": 40},
]
EV_KINDS = [("ts", "str"), ("user_id", "str"), ("event_type", "str"), ("value", "double"), ("props", "str")]


@query("stream_landing_to_raw", f"""
SELECT *, CASE WHEN r <> '' THEN 'N' ELSE 'Y' END AS data_quality_valid_flag FROM (
SELECT e.*, {md5_of([('event_id', 'str')])} AS hkey, {md5_of(EV_KINDS)} AS hdiff,
  concat_ws(',', CASE WHEN coalesce(NOT (event_type IN ('click', 'view', 'purchase', 'signup')), false) THEN '701' END,
                 CASE WHEN coalesce(NOT (value < 40), false) THEN '702' END) AS r
FROM events e) x""".replace("AS r\n", "AS data_quality_result_array\n").replace("WHEN r <>", "WHEN data_quality_result_array <>"))
def stream_landing_to_raw(spark, d):
    """Per micro-batch (plans.flows.landing_to_raw): de-duplicate on the key,
    hash, flag rules, upsert on hkey into the raw snapshot."""
    root = scratch_path(spark, "stream-raw")

    def load(target, batch):
        return flows.landing_to_raw(target, batch, ["event_id"], ["ts"], rules=RAW_RULES)
    out = BucketedTable(spark, f"{root}/out", ["event_id"], buckets=8)
    _run_batches(spark, d, root, out.loader(load))
    return out.read().withColumn("data_quality_result_array", F.array_join("data_quality_result_array", ","))


WAVE = "CASE " + " ".join(f"WHEN ts < TIMESTAMP '{w} 00:00:00' THEN {i}" for i, w in enumerate(WAVES[1:])) + " END"


@query("stream_audit_rows", f"""
WITH e AS (SELECT *, CAST({WAVE} AS BIGINT) AS batch_id FROM events),
  u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e) WHERE rn = 1)
SELECT 'landed' AS source, batch_id, 'Target_Append_Count' AS audit_record_type_desc, count(*) AS audit_value FROM e GROUP BY batch_id
UNION ALL SELECT 'landed', batch_id, 'Purchase_Count', count(*) FILTER (WHERE event_type = 'purchase') FROM e GROUP BY batch_id
UNION ALL SELECT 'raw', batch_id, 'Source_Object_Raw_Count', count(*) FROM e GROUP BY batch_id
UNION ALL SELECT 'raw', batch_id, 'Source_Object_DeDupe_Count', count(*) FROM u GROUP BY batch_id
UNION ALL SELECT 'raw', batch_id, 'rules.701', count(*) FILTER (WHERE NOT (event_type IN ('click', 'view', 'purchase', 'signup'))) FROM u GROUP BY batch_id
UNION ALL SELECT 'raw', batch_id, 'rules.702', count(*) FILTER (WHERE NOT (value < 40)) FROM u GROUP BY batch_id""")
def stream_audit_rows(spark, d):
    """Audit rows of every micro-batch: of an appending stream from its progress, of a merge from its observations."""
    root = scratch_path(spark, "stream-audit")
    log = AuditLog(spark, f"{root}/audit", AS_OF, 7, 42)
    listener = ProgressAudit(log, {"landed"})
    raw = BucketedTable(spark, f"{root}/raw", ["user_id"], buckets=8)

    def load(target, batch):
        return flows.landing_to_raw(target, batch, ["user_id"], ["ts"], ["event_id"], rules=RAW_RULES)
    merge = raw.loader(load, log.on_commit("raw", {"raw.rows": "Source_Object_Raw_Count", "dedup.rows": "Source_Object_DeDupe_Count", "batch.rows": None}))
    spark.streams.addListener(listener)
    try:
        for _ in _waves(spark, d, root):
            s = observed(stream(spark, "parquet", f"{root}/landing", {}), "landed", Target_Append_Count=F.count(F.lit(1)),
                         Purchase_Count=F.count_if(F.col("event_type") == "purchase"))
            listener.wait(ss.append(s, f"{root}/log", f"{root}/_checkpoint-log"))
            ss.for_each_batch(stream(spark, "parquet", f"{root}/landing", {}), merge, f"{root}/_checkpoint")
    finally:
        spark.streams.removeListener(listener)
    return log.rows().select("source", "batch_id", "audit_record_type_desc", "audit_value")


@query("stream_update_counts", """
SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n, max(value) AS top
FROM events GROUP BY 1, 2""")
def stream_update_counts(spark, d):
    """A stateful aggregate in update mode: each batch hands over only the groups it changed, which are merged."""
    root = scratch_path(spark, "stream-update")

    def changed(s):
        # the same wall clock in UTC, whatever the session's time zone: windows are cut in UTC
        micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
        s = s.withColumn("event_time", F.timestamp_micros(micros)).withWatermark("event_time", "3 days")
        g = s.groupBy(F.window("event_time", "1 day").alias("w"), "event_type")
        g = g.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
        day = F.expr("timestampadd(MICROSECOND, unix_micros(w.start), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
        return g.select(day.alias("day"), "event_type", "n", "top")
    out = BucketedTable(spark, f"{root}/out", ["day", "event_type"], buckets=8)
    merge = out.loader(lambda target, batch: batch if target is None else scd.scd1_full_join(target, batch, ["day", "event_type"]))
    _run_batches(spark, d, root, merge, changed, output_mode="update")
    return out.read()


@query("stream_append_table", f"""
SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts < TIMESTAMP '{WAVES[1]} 00:00:00' THEN NULL ELSE props END AS props FROM events""")
def stream_append_table(spark, d):
    """A stream into a catalog table; from the second wave on it has one column more."""
    root = scratch_path(spark, "stream-table")
    name = "curata_stream_" + root.rsplit("-", 1)[-1]
    for i, _ in enumerate(_waves(spark, d, root)):
        s = stream(spark, "parquet", f"{root}/landing", {})
        ss.append_table(s if i else s.drop("props"), name, f"{root}/_checkpoint", merge_schema=True, path=f"{root}/table")
    return spark.table(name)


@query("stream_dedupe_watermark", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe_watermark(spark, d):
    root = scratch_path(spark, "stream-dedupe")
    # watermarks need a zoned timestamp; the table's ts is timestamp_ntz
    s = (_events_stream(spark, d).withColumn("event_time", F.col("ts").cast("timestamp"))
         .withWatermark("event_time", "10 minutes")
         .dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type"))
    ss.append(s, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")
