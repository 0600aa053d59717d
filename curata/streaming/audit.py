"""Audit rows per micro-batch: counts that Spark observes while a batch is
processed, kept under (source, batch), so a replayed batch replaces its rows.

Merges in foreachBatch report their Observations through ``AuditLog.on_commit``;
plain sinks carry ``observed`` columns whose values ``ProgressAudit`` takes from the
progress of the query.  Neither runs a job over the data to count it.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.audit import FACT_SCHEMA

SCHEMA = f"{FACT_SCHEMA}, source string, batch_id bigint"


class AuditLog:
    """Audit fact rows of streams under ``root``: one folder per source and batch."""

    def __init__(self, spark: SparkSession, root: str, as_of: str | None = None, sla_dim_id: int = 0, audit_dim_id: int = 0):
        self.spark, self.root, self.as_of = spark, root.rstrip("/"), as_of
        self.sla_dim_id, self.audit_dim_id = sla_dim_id, audit_dim_id

    def record(self, source: str, batch_id: int, counts: dict[str, int]) -> None:
        """One row per count of a batch."""
        at = dt.datetime.fromisoformat(self.as_of) if self.as_of else dt.datetime.now()
        rows = [(self.sla_dim_id, kind, at, n, "Y", self.audit_dim_id, source, batch_id) for kind, n in counts.items()]
        (self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/{source}/{batch_id}"))

    def on_commit(self, source: str, kinds: dict[str, str | None] | None = None) -> Callable[[int, dict], None]:
        """For ``BucketedTable.loader``: every observed value becomes a row, named
        "<observation>.<field>" or as ``kinds`` says (None: no row)."""
        def fn(batch_id: int, metrics: dict) -> None:
            flat = {f"{name}.{field}": n for name, got in metrics.items() for field, n in got.items()}
            named = {(kinds or {}).get(k, k): n for k, n in flat.items()}
            if named:
                self.record(source, batch_id, {k: n for k, n in named.items() if k is not None})
        return fn

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.root)


def observed(df: DataFrame, name: str, **counts: Column) -> DataFrame:
    """``df`` with aggregates that the progress of its query reports under ``name`` (default: the row count)."""
    cols = counts or {"rows": F.count(F.lit(1))}
    return df.observe(name, *[c.alias(k) for k, c in cols.items()])


class ProgressAudit(StreamingQueryListener):
    """Writes what queries observe into an ``AuditLog``, batch by batch.  The names
    of ``observed`` are the sources; other observations are left alone."""

    def __init__(self, log: AuditLog, sources: set[str]):
        self.log, self.sources = log, set(sources)
        self._done: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, query_id: str) -> threading.Event:
        with self._lock:
            return self._done.setdefault(query_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        for source, row in event.progress.observedMetrics.items():
            if source in self.sources:
                self.log.record(source, event.progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def wait(self, query, seconds: float = 60.0) -> None:
        """Block until all progress of a finished query has been written."""
        if not self._event(str(query.runId)).wait(seconds):
            raise TimeoutError("the query's progress has not arrived")
