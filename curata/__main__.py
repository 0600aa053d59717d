"""Run one configured load: ``python -m curata load.json``.

The JSON file holds one load (the decoded control row):

    {"source": {"source_table_type": "parquet", "path": "..."},
     "steps": [...], "dq": {"active": [...], "passive": [...]},
     "load": {"type": "update", "keys": [...], "order": [...]},
     "target": {"table": "curated.orders", "root": "<shared folder>",
                "bucket_by": [64, ["o_orderkey"]]},
     "quarantine": {"table": "curated.orders_invalid", "root": "<shared folder>"},
     "audit": {"url": "jdbc:...", "table": "AUDIT_FACT", "properties": {...}}}

With "targets" ({table: load}) instead of "load" and "target" the source is loaded into
every table and all are published together under "root".  A streaming source
({"streaming": true, "format": ..., "path": ...}) needs "root" and "checkpoint": what
has arrived is merged batch by batch (counts of every batch under <root>-audit).  With
"state" ({"root": ...}), "change_col" and a source of "initial_filepath" and
"delta_filepath" the load goes on from its committed watermark.

``root`` defaults to spark.sql.warehouse.dir.  ``master`` and
``shuffle_partitions`` may be named for local runs; by default both come from
the submitted configuration.  Held-back rows are appended to the quarantine
table.  The target
table (if it exists) is the merge target; the new content is
published as a fresh snapshot and the table re-pointed.  Counts are printed
as one JSON line.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from .plans import state
from .plans.loader import load_targets, run_config_load, run_stream_load
from .sources.sinks import append_write, publish_snapshot
from .streaming.audit import AuditLog


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    argv = list(sys.argv[1:] if argv is None else argv)
    if len(argv) != 1:
        raise SystemExit("usage: python -m curata <load.json>")
    with open(argv[0], encoding="utf-8") as fh:
        config = json.load(fh)
    if spark is None:
        from .session import build_session
        spark = build_session(master=config.get("master"), shuffle_partitions=config.get("shuffle_partitions"))
    special = _special(spark, config)
    if special is not None:
        print(json.dumps(special))
        return special
    tgt_cfg = config.get("target", {})
    name = tgt_cfg.get("table")
    target = spark.table(name) if name and spark.catalog.tableExists(name) else None
    new, info = run_config_load(spark, config, target)
    out = {"skipped": bool(info.get("skipped"))}
    if info.get("skipped"):
        print(json.dumps(out))
        return out
    default_root = spark.conf.get("spark.sql.warehouse.dir")
    q = config.get("quarantine")
    if q and info["invalid"] is not None:
        where = f"{q.get('root', default_root).rstrip('/')}/{q['table'].replace('.', '_')}"
        append_write(info["invalid"], table=q["table"], options={"path": where})       # earlier rows stay
    if name:
        bucket = tgt_cfg.get("bucket_by")
        out["snapshot"] = publish_snapshot(spark, new, name, tgt_cfg.get("root", default_root),
                                           bucket_by=(bucket[0], bucket[1]) if bucket else None)
    else:
        new.write.format("noop").mode("overwrite").save()
    out.update({"steps": info["steps"], "source_rows": info["source_rows"].get.get("rows"),
                "loaded_rows": info["loaded_rows"].get.get("rows")})
    a = config.get("audit")
    if a:
        _write_audit(spark, a, out)
    print(json.dumps(out))
    return out


def _special(spark: SparkSession, config: dict) -> dict | None:
    """Loads other than one batch into one table."""
    if "targets" in config:
        return {"snapshots": load_targets(spark, config, config.get("root", spark.conf.get("spark.sql.warehouse.dir")))}
    if config["source"].get("streaming"):
        root = config["root"].rstrip("/")
        audit = AuditLog(spark, f"{root}-audit")
        out = run_stream_load(spark, config, root, config["checkpoint"], audit=audit)
        return {"rows": 0 if out is None else out.count()}
    if "state" in config:
        done = state.run(spark, config, config["state"]["root"], config.get("until"))
        return dict(done.__dict__)
    return None


def _write_audit(spark: SparkSession, a: dict, out: dict) -> None:
    """Audit count rows (audit-fact layout) appended to a JDBC table."""
    import datetime as dt
    from .operators.audit import FACT_SCHEMA
    from .sources.jdbc import write_jdbc
    now = dt.datetime.fromisoformat(a["as_of"]) if a.get("as_of") else dt.datetime.now()
    counts = [("source_row_count", out["source_rows"]), ("loaded_row_count", out["loaded_rows"]),
              ("invalid_row_count", out["source_rows"] - out["loaded_rows"])]
    rows = [(a.get("sla_dim_id", 0), kind, now, int(v), "Y", a.get("audit_dim_id", 0)) for kind, v in counts]
    write_jdbc(spark.createDataFrame(rows, FACT_SCHEMA), a["url"], a["table"], a.get("properties"))


if __name__ == "__main__":
    main()
