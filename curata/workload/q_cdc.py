"""Query keys: change data capture over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, dedupe
from .inputs import cdc_events, with_
from .registry import query

SPLIT_TS = "2024-01-30 00:00:00"
W = "PARTITION BY user_id ORDER BY ts DESC, event_id DESC"
STATE = with_("cdc_events", extra={
    "tgt": f"SELECT * EXCLUDE (rn, op) FROM (SELECT *, row_number() OVER ({W}) rn FROM cdc_events "
           f"WHERE ts < TIMESTAMP '{SPLIT_TS}') WHERE rn = 1",
    "chg": f"SELECT * FROM cdc_events WHERE ts >= TIMESTAMP '{SPLIT_TS}'",
})


def _state(spark, d):
    ev = cdc_events(spark, d)
    before = ev.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    target = dedupe.latest_per_key(before, ["user_id"], ["ts"], ["event_id"]).drop("op")
    changes = cdc.ChangeFrame(ev.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz")), ["user_id"])
    return target, changes


@query("cdc_split", with_("cdc_events") + """
SELECT *, CASE op WHEN 'insert' THEN 'inserts' WHEN 'update' THEN 'updates' ELSE 'deletes' END AS split FROM cdc_events""")
def cdc_split(spark, d):
    cf = cdc.ChangeFrame(cdc_events(spark, d), ["user_id"])
    return (cf.inserts().withColumn("split", F.lit("inserts"))
            .unionByName(cf.updates().withColumn("split", F.lit("updates")))
            .unionByName(cf.deletes().withColumn("split", F.lit("deletes"))))


@query("cdc_remove_deleted", STATE + """
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM chg c WHERE c.op = 'delete' AND c.user_id = t.user_id)""")
def cdc_remove_deleted(spark, d):
    target, changes = _state(spark, d)
    return cdc.remove_deleted(target, changes.deletes(), ["user_id"])


@query("cdc_apply", STATE[:-1] + f""",
lat AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ({W}) rn FROM chg) WHERE rn = 1)
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM lat l WHERE l.user_id = t.user_id)
UNION ALL SELECT * EXCLUDE (op) FROM lat WHERE op <> 'delete'""")
def cdc_apply(spark, d):
    target, changes = _state(spark, d)
    return cdc.apply_changes(target, changes, ["ts"], ["event_id"])
