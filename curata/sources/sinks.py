"""Batch sinks: overwrite, append, create-if-missing, fan-out, snapshot publish.

A load never overwrites the folder it reads from: a new snapshot is written
to a fresh folder and the table is re-pointed to it (``publish_snapshot``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..constants import CONTROL_COLUMNS

MODES = ("overwrite", "append", "error", "ignore")


def write(df: DataFrame, mode: str, fmt: str = "parquet", path: str | None = None, table: str | None = None,
          options: dict | None = None, partition_by: Sequence[str] = ()) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    w = df.write.format(fmt).mode(mode)
    if options:
        w = w.options(**{k: str(v) for k, v in options.items()})
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        w.saveAsTable(table)
    else:
        w.save(path)


def overwrite_write(df, fmt="parquet", path=None, table=None, options=None, partition_by=()):
    write(df, "overwrite", fmt, path, table, options, partition_by)


def append_write(df, fmt="parquet", path=None, table=None, options=None, partition_by=()):
    write(df, "append", fmt, path, table, options, partition_by)


def create_empty_table(spark: SparkSession, schema_df: DataFrame, name: str, scd_type: int = 2,
                       location: str | None = None, fmt: str = "parquet") -> None:
    """Create an empty table from a DataFrame's schema; a type-1 table drops
    the SCD control columns.  With ``location`` the table is external."""
    if scd_type not in (1, 2):
        raise ValueError("scd_type must be 1 or 2")
    df = schema_df.limit(0)
    if scd_type == 1:
        df = df.drop(*[c for c in CONTROL_COLUMNS if c in df.columns])
    w = df.write.format(fmt).mode("error")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def fanout(df: DataFrame, sinks: Sequence[dict]) -> None:
    """Write one source to several sinks, computing it once.

    When the first sink is an overwrite in a self-describing format (or a
    catalog table), the later sinks read the rows back
    from it: the source plan runs once, nothing is held in executor memory,
    and a lost executor costs a re-read of files, not a recomputation.
    Otherwise the frame is persisted (memory and disk) for the writes.
    """
    if not sinks:
        return
    first, rest = sinks[0], list(sinks[1:])
    if not rest:
        _write_spec(df, first)
        return
    fmt = first.get("format", "parquet")
    typed = first.get("table") or fmt in ("parquet", "orc", "avro", "delta")
    if first.get("mode", "append") == "overwrite" and typed:
        spark = df.sparkSession
        _write_spec(df, first)
        src = (spark.read.table(first["table"]) if first.get("table")
               else spark.read.format(fmt).options(**{k: str(v) for k, v in (first.get("options") or {}).items()
                                                      if k != "path"}).load(first["path"]))
        for s in rest:
            _write_spec(src, s)
        return
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for s in sinks:
            _write_spec(cached, s)
    finally:
        cached.unpersist()


def _write_spec(df: DataFrame, s: dict) -> None:
    write(df, s.get("mode", "append"), s.get("format", "parquet"), s.get("path"), s.get("table"),
          s.get("options"), s.get("partition_by", ()))


def publish_snapshot(spark: SparkSession, df: DataFrame, table: str, root: str, fmt: str = "parquet",
                     partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None,
                     repartition_by: tuple[int, Sequence[str]] | None = None) -> str:
    """Write ``df`` as a new snapshot folder, then point ``table`` at it.

    Readers of the old snapshot are never disturbed, and a failed write leaves
    the table on its previous snapshot (a partitioned or bucketed table has no
    name for the moment between dropping the old entry and renaming the new).  ``bucket_by=(n, keys)`` writes the
    snapshot bucketed (and sorted) by the business key: the next merge joins
    the table on that key without shuffling it -- only the batch is
    shuffled.  ``partition_by=["is_current"]`` lets the open-row read of the
    next type-2 merge prune the closed history.  ``repartition_by=(n, keys)``
    compacts the snapshot into ``n`` files clustered by key (every snapshot
    is a full rewrite, so small files never pile up across loads).  Returns
    the new folder.
    """
    path = f"{root.rstrip('/')}/{table.replace('.', '_')}/v-{uuid.uuid4().hex[:16]}"
    if repartition_by is not None:
        n_files, by = repartition_by
        df = df.repartition(n_files, *by)
    if bucket_by is None and not partition_by:
        write(df, "error", fmt, path=path)
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=path, source=fmt)
        return path
    # partitions and buckets belong to the table's own metadata, which a changed
    # location would leave behind: the snapshot is registered whole under a
    # staging name, then that entry takes the table's name (external: files stay)
    stage = f"{table}__v{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt).option("path", path)
    if bucket_by is not None:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(stage)
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    return path


def publish_together(spark: SparkSession, contents: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Publish new snapshots of several tables, all or none.

    Every snapshot is written before any table moves; a failed write leaves all
    tables as they were.  If moving a table fails, the ones already moved go back.
    Returns {table: folder}.
    """
    paths = {}
    for table, df in contents.items():
        paths[table] = f"{root.rstrip('/')}/{table.replace('.', '_')}/v-{uuid.uuid4().hex[:16]}"
        write(df, "error", fmt, path=paths[table])
    moved: list[tuple[str, str | None]] = []
    try:
        for table, path in paths.items():
            before = None
            if spark.catalog.tableExists(table):
                rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
                before = rows[0]["data_type"]
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                spark.catalog.refreshTable(table)
            else:
                spark.catalog.createTable(table, path=path, source=fmt)
            moved.append((table, before))
    except Exception:
        for table, before in reversed(moved):
            spark.sql(f"DROP TABLE {table}" if before is None else f"ALTER TABLE {table} SET LOCATION '{before}'")
            if before is not None:
                spark.catalog.refreshTable(table)
        raise
    return paths


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: later
    steps read files, at a size known to the planner, instead of recomputing it.
    The files stay there for the deployment to expire."""
    from ..session import checkpoint_root
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/curata/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if its rows come straight from their files, else ``staged``: for a frame
    that several steps read and that takes a shuffle each time it is computed."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return staged(df, name) if "Exchange" in plan else df


def materialize(spark: SparkSession, df: DataFrame, name: str, database: str = "curata_staging") -> tuple[DataFrame, str]:
    """Write a staging frame as a managed table of a staging database that
    lives under the shared checkpoint folder, and read it back.

    Later steps read files instead of recomputing the staging plan, and the
    lineage is cut (unlike an in-memory cache, this survives lost executors).
    Returns (frame, table name); ``drop_staging`` drops the table and, since
    it is managed, its files.
    """
    from ..session import checkpoint_root
    root = checkpoint_root(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}'")
    table = f"{database}.{name}_{uuid.uuid4().hex[:12]}"
    df.write.mode("error").format("parquet").saveAsTable(table)
    return spark.table(table), table


def drop_staging(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
