"""Config-driven load: source read -> step chain -> load into the target.

The config is a plain dict (one control row, JSON columns decoded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.loads import apply_load
from ..sources import files, jdbc, sinks, tables
from . import steps as step_mod

READERS = {
    "parquet": lambda spark, c: files.read_parquet(spark, c["path"], c.get("options"), c.get("as_of", "2002-01-01 00:00:00")),
    "csv": lambda spark, c: files.read_csv(spark, c["path"], c.get("options"), c.get("schema")),
    "json": lambda spark, c: files.read_json(spark, c["path"], c.get("options"), c.get("schema")),
    "orc": lambda spark, c: files.read_orc(spark, c["path"], c.get("options")),
    "path": lambda spark, c: files.read_format_path(spark, c["path"], c.get("options"), c.get("format", "parquet")),
    "table": lambda spark, c: tables.read_table(spark, c["table"]),
    "jdbc": lambda spark, c: jdbc.read_jdbc(spark, c["url"], f"({c['query']}) q" if c.get("query") else c["table"], c.get("properties"),
                                            c.get("partition_column"), c.get("lower"), c.get("upper"), c.get("num_partitions")),
    "table3": lambda spark, c: tables.read_three_level(spark, c["table"]),
}


def read_source(spark: SparkSession, source: dict) -> DataFrame:
    """Dispatch on ``source_table_type``; ``streaming`` returns a stream."""
    kind = source.get("source_table_type", "parquet")
    if source.get("streaming"):
        from ..streaming.sources import stream
        return stream(spark, source.get("format", kind), source["path"], source.get("options"), source.get("schema"))
    if kind not in READERS:
        raise ValueError(f"unknown source_table_type {kind!r}")
    return READERS[kind](spark, source)


def run_load(spark: SparkSession, config: dict, target: DataFrame | None = None,
             registry: dict | None = None) -> DataFrame:
    """Read, transform, and compute the new target content."""
    df = read_source(spark, config["source"])
    if config.get("skip_if_empty") and not df.isStreaming and files.is_empty(df):
        return target                       # empty source: the target stays as it is
    df, _ = step_mod.run(df, config.get("steps", []), registry)
    load = config.get("load")
    if not load:
        return df
    return load_into(load, target, df)


def load_into(load: dict, target: DataFrame | None, df: DataFrame) -> DataFrame:
    return apply_load(load["type"], target, df, load["keys"], load.get("order", []), load.get("ties", ()),
                      load.get("as_of"), load.get("start_cols", ()), load.get("compare"))


def run_targets(spark: SparkSession, config: dict, targets: dict[str, DataFrame | None],
                registry: dict | None = None) -> dict[str, DataFrame]:
    """One source, several targets: {name: new content} for every entry of
    ``config["targets"]`` (name -> its own load).

    Source, steps and data-quality checks are evaluated once: the rows to load are
    staged as files under the shared folder and every target's load reads those.  A
    single target reads the source itself.
    """
    df = read_source(spark, config["source"])
    df, _ = step_mod.run(df, config.get("steps", []), registry)
    df, _ = _checked(df, config.get("dq"))
    if len(config["targets"]) > 1:
        df = sinks.staged(df, "targets")
    return {name: load_into(load, targets.get(name), df) for name, load in config["targets"].items()}


def load_targets(spark: SparkSession, config: dict, root: str, registry: dict | None = None) -> dict[str, str]:
    """``run_targets`` for tables: merges the source into every table that
    ``config["targets"]`` names and publishes all new snapshots together, or none if one
    fails.  Returns {table: snapshot folder}."""
    now = {name: spark.table(name) if spark.catalog.tableExists(name) else None for name in config["targets"]}
    return sinks.publish_together(spark, run_targets(spark, config, now, registry), root)


def run_stream_load(spark: SparkSession, config: dict, root: str, checkpoint: str, initial: DataFrame | None = None,
                    registry: dict | None = None, audit=None) -> DataFrame | None:
    """A configured load of a streaming source: every micro-batch runs the steps, the
    data-quality checks and the load.  Processes what has arrived (availableNow) and
    returns the table as it is then, also when nothing new has arrived (None or
    ``initial`` before the first batch).

    Type-1 and type-2 loads rewrite only the key buckets a batch reaches
    (``streaming.buckets``; ``load["buckets"]``, default 64); other load types write one
    snapshot per batch.  Rows that fail an active check go to ``<root>-invalid``, one
    folder per batch.  ``audit`` (an ``AuditLog``) takes the counts of every batch.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    from ..streaming import sinks as ss
    from ..streaming.buckets import BucketedTable
    load_cfg, dq = config["load"], config.get("dq")
    kind = load_cfg["type"].lower()

    def prepared(batch: DataFrame) -> DataFrame:
        return step_mod.run(batch, config.get("steps", []), registry)[0]

    def load(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        return load_into(load_cfg, target, batch)

    def checked(batch: DataFrame, batch_id: int) -> tuple[DataFrame, dict]:
        """The batch's rows to load; with checks the others are written and both are counted as they are."""
        batch = prepared(batch)
        if not dq:
            return batch, {}
        good, bad = _checked(batch, dq, obs := Observation())
        bad.write.mode("overwrite").parquet(ss.batch_path(f"{root.rstrip('/')}-invalid", batch_id))
        return good, {"source": obs.get}
    done = audit.on_commit("load") if audit is not None else (lambda batch_id, metrics: None)
    source = read_source(spark, config["source"])
    if kind in ("update", "scd2"):
        versions = kind == "scd2"
        table = BucketedTable(spark, root, load_cfg["keys"], load_cfg.get("buckets", 64),
                              open_when="is_current = 1 AND is_deleted = 0" if versions else None,
                              start="start_time" if versions else None, batch_start=load_cfg["order"][0] if versions else None)
        if initial is not None and not table.versions():
            table.seed(initial)

        def fn(batch: DataFrame, batch_id: int) -> None:
            good, counts = checked(batch, batch_id)
            done(batch_id, {**counts, **table.merge(good, batch_id, load)})
        ss.for_each_batch(source, fn, checkpoint)
        return table.read()
    write = ss.snapshot_loader(spark, root, load, initial)

    def fn(batch: DataFrame, batch_id: int) -> None:
        good, counts = checked(batch, batch_id)
        obs = Observation()
        write(good.observe(obs, F.count(F.lit(1)).alias("rows")), batch_id)
        done(batch_id, {**counts, "batch": obs.get})
    ss.for_each_batch(source, fn, checkpoint)
    last = ss.newest_snapshot(spark, root)
    return initial if last is None else last


def _checked(df: DataFrame, dq: dict | None, obs=None) -> tuple[DataFrame, DataFrame | None]:
    """(rows to load, rows held back) by the active and passive checks of ``dq``;
    ``obs`` counts both while the rows held back are written."""
    from pyspark.sql import functions as F
    from ..operators import quality
    if not dq:
        return df, None
    flagged = quality.active_passive(df, dq.get("active", []), dq.get("passive", []))
    good = flagged.where(~F.col("blocked")).drop("blocked", "active_reason")
    if obs is not None:
        flagged = flagged.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if("blocked").alias("invalid"))
    return good if dq.get("passive") else good.drop("passive_reason"), flagged.where("blocked").drop("blocked")


def run_config_load(spark: SparkSession, config: dict, target: DataFrame | None = None,
                    registry: dict | None = None) -> tuple[DataFrame | None, dict]:
    """The whole configured load: read -> steps -> data quality -> load.

    ``config["dq"] = {"active": [...], "passive": [...]}``: rows failing an
    active check are held back (returned as ``info["invalid"]`` with their
    reasons, for a quarantine table), passive failures stay in the load with
    ``passive_reason`` set.  ``info`` also carries the step ids and
    Observations of the source and loaded row counts, filled when the new
    target is written -- no extra jobs.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    df = read_source(spark, config["source"])
    if config.get("skip_if_empty") and not df.isStreaming and files.is_empty(df):
        return target, {"skipped": True}
    df, step_ids = step_mod.run(df, config.get("steps", []), registry)
    src_obs, out_obs = Observation(), Observation()
    df = df.observe(src_obs, F.count(F.lit(1)).alias("rows"))
    df, invalid = _checked(df, config.get("dq"))
    df = df.observe(out_obs, F.count(F.lit(1)).alias("rows"))
    load = config.get("load")
    new = df if not load else load_into(load, target, df)
    return new, {"steps": step_ids, "source_rows": src_obs, "loaded_rows": out_obs, "invalid": invalid}
