"""Stream sinks: append, per-batch overwrite, snapshot loads through
foreachBatch.  Every query runs to completion with trigger(availableNow)
unless a processing-time trigger is given, and keeps its progress in a
checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def append(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", query_name: str | None = None,
           merge_schema: bool = True, trigger: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append a stream to a file sink (exactly-once through the sink log)."""
    w = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .option("mergeSchema", str(merge_schema).lower()))
    if query_name:
        w = w.queryName(query_name)
    q = _trigger(w, trigger).start(path)
    if wait:
        q.awaitTermination()
    return q


def append_table(df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet", query_name: str | None = None,
                 merge_schema: bool = False, trigger: str | None = None, wait: bool = True, path: str | None = None) -> StreamingQuery:
    """Append a stream to a catalog table (created by the first run, external with ``path``).

    With ``merge_schema`` columns that the table lacks are added to it first, so
    earlier rows read null there; without it such a column is refused.  A type
    that differs from the table's is refused either way.  A table belongs to one
    checkpoint: its log counts that checkpoint's batches, and skips numbers it has.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        have = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
        for f in df.schema.fields:
            if f.name.lower() in have and have[f.name.lower()] != f.dataType:
                raise ValueError(f"{table}.{f.name} is {have[f.name.lower()].simpleString()}, the stream has {f.dataType.simpleString()}")
        new = [f for f in df.schema.fields if f.name.lower() not in have]
        if new and not merge_schema:
            raise ValueError(f"{table} lacks {', '.join(f.name for f in new)}; merge_schema adds columns")
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
        df = df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in spark.table(table).schema.fields])
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if path is not None:
        w = w.option("path", path)
    q = _trigger(w, trigger).toTable(table)
    if wait:
        q.awaitTermination()
    return q


def for_each_batch(df: DataFrame, fn: Callable, checkpoint: str, query_name: str | None = None,
                   trigger: str | None = None, output_mode: str = "append", wait: bool = True) -> StreamingQuery:
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if query_name:
        w = w.queryName(query_name)
    q = _trigger(w, trigger).start()
    if wait:
        q.awaitTermination()
    return q


def batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch={batch_id}"


def overwrite_latest(spark: SparkSession, root: str, transform: Callable[[DataFrame], DataFrame]):
    """foreachBatch function: each batch's transformed rows (e.g. latest per
    key) become the table's full content.  Written to a folder named by the
    batch id, so a replayed batch rewrites the same folder."""
    def fn(batch_df: DataFrame, batch_id: int):
        transform(batch_df).write.mode("overwrite").parquet(batch_path(root, batch_id))
    return fn


def snapshot_loader(spark: SparkSession, root: str, load: Callable[[DataFrame | None, DataFrame], DataFrame],
                    initial: DataFrame | None = None, bucket_by: tuple[int, list] | None = None,
                    table_prefix: str | None = None):
    """foreachBatch function for merges (SCD-1, SCD-2, CDC) without a
    row-level table format.

    Batch N reads the snapshot of batch N-1 (``initial`` or None for the
    first batch -- the first-load case), applies ``load(target, batch)`` and
    writes snapshot N to its own folder.  Readers never see a half-written
    folder, the lineage is cut at every batch (the target is re-read from
    files), and a replay of batch N recomputes exactly the same snapshot.

    With ``bucket_by=(n, keys)`` each snapshot is also a catalog table
    ``<table_prefix>_b<N>`` bucketed and sorted by the keys, so the next
    batch's merge joins it without shuffling the target -- only the batch
    moves.  If the catalog forgot the table (a new session without a
    persistent metastore), it is registered again from its folder with the
    same bucket spec.
    """
    if bucket_by and not table_prefix:
        raise ValueError("bucket_by needs a table_prefix")

    def _table(batch_id: int) -> str:
        return f"{table_prefix}_b{batch_id}"

    def _target(batch_id: int, spark: SparkSession):
        if batch_id == 0:
            return initial
        prev = batch_path(root, batch_id - 1)
        if not bucket_by:
            return spark.read.parquet(prev)
        name = _table(batch_id - 1)
        if not spark.catalog.tableExists(name):
            n, keys = bucket_by
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(prev).schema)
            ks = ", ".join(f"`{k}`" for k in keys)
            spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({ks}) SORTED BY ({ks}) "
                      f"INTO {n} BUCKETS LOCATION '{prev}'")
        return spark.table(name)

    def fn(batch_df: DataFrame, batch_id: int):
        # foreachBatch has a session of its own: what a plan observes is reported to the session of all its parts
        new = load(_target(batch_id, batch_df.sparkSession), batch_df)
        path = batch_path(root, batch_id)
        if bucket_by:
            n, keys = bucket_by
            (new.write.mode("overwrite").format("parquet").option("path", path)
             .bucketBy(n, *keys).sortBy(*keys).saveAsTable(_table(batch_id)))
        else:
            new.write.mode("overwrite").parquet(path)
    return fn


def newest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The last complete folder that ``snapshot_loader`` or ``overwrite_latest`` wrote (None: no batch yet)."""
    from ..sources import commits
    batches = [int(n[6:]) for n in commits.names(spark, root) if n.startswith("batch=")]
    for n in sorted(batches, reverse=True):
        if "_SUCCESS" in commits.names(spark, batch_path(root, n)):
            return spark.read.parquet(batch_path(root, n))
    return None


def last_batch(q: StreamingQuery) -> int | None:
    """Id of the last batch the query ran (None when it processed nothing)."""
    ids = [p["batchId"] for p in q.recentProgress if p.get("numInputRows", 0) > 0]
    return max(ids) if ids else None
