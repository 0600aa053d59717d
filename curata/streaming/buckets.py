"""A merged table that a micro-batch rewrites only where it reaches.

Parquet has no row-level MERGE, and a whole new snapshot per micro-batch costs as
much as the table.  Here the rows are dealt into key-hash buckets and split into
open rows and closed history:

    <root>/v=<batch>/_state=open/_bucket=<b>/     open rows of a bucket, all of them
    <root>/v=<batch>/_state=closed/_bucket=<b>/   rows that batch closed (added, not replaced)
    <root>/_manifest/<batch>.json                 which versions make up the table

A batch reads the open rows of the buckets its keys fall into, merges them and writes
those buckets under its own version; all other files stay as they are.  Closed rows are
only read, and their bucket only replaced, where a batch row starts at or before the
open row of its key, or where a bucket's closed rows lie in ``compact_after`` versions.

The manifest is the commit: it is written last, under another name first.  A replayed
batch starts from the manifest before it and writes the same version again, so it
changes nothing.  A failed batch leaves files that no manifest names.

Retention: the last ``keep`` manifests stay readable; a file that none of them names is
deleted once a later batch is committed.  One table belongs to one stream checkpoint
(batch ids must go on rising).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import commits

STATES = ("open", "closed")


class BucketedTable:
    """``open_when``: condition (SQL text) of the open rows; None: every row is open (type 1).
    ``start``: column that orders the versions of a key in the table, ``batch_start`` the same
    in a batch (default: ``start``); without it closed history is never read back."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64,
                 open_when: str | None = None, start: str | None = None, batch_start: str | None = None,
                 keep: int = 2, compact_after: int = 20):
        if keep < 2 or buckets < 1 or compact_after < 1:
            raise ValueError("keep must be at least 2 (a replay starts from the batch before), buckets and compact_after 1")
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.open_when, self.start, self.batch_start = open_when, start, batch_start or start
        self.keep, self.compact_after = keep, compact_after

    # ------------------------------------------------------------- manifests
    def versions(self) -> list[int]:
        """Ids of the batches whose state can be read, oldest first."""
        return commits.numbers(self.spark, f"{self.root}/_manifest")

    def manifest(self, batch_id: int) -> dict:
        m = commits.read(self.spark, f"{self.root}/_manifest", batch_id)
        return {**m, "open": {int(b): v for b, v in m["open"].items()}, "closed": {int(b): v for b, v in m["closed"].items()}}

    @staticmethod
    def _files(m: dict) -> set[tuple[int, str, int]]:
        return {(v, "open", b) for b, v in m["open"].items()} | {(v, "closed", b) for b, vs in m["closed"].items() for v in vs}

    # --------------------------------------------------------------- reading
    def _leaf(self, v: int, state: str, bucket: int) -> str:
        return f"{self.root}/v={v}/_state={state}/_bucket={bucket}"

    def _frame(self, m: dict, files, spark: SparkSession | None = None) -> DataFrame:
        spark = spark or self.spark
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        paths = sorted(self._leaf(*f) for f in files)
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, batch_id: int | None = None, state: str | None = None) -> DataFrame | None:
        """The table as of a batch (default: the last one), or its open or closed rows; None before the first batch."""
        have = self.versions()
        if not have:
            return None
        m = self.manifest(have[-1] if batch_id is None else batch_id)
        return self._frame(m, [f for f in self._files(m) if state in (None, f[1])])

    # --------------------------------------------------------------- merging
    def _bucket(self, schema: T.StructType | None) -> Column:
        cols = [F.col(k).cast(schema[k].dataType) if schema is not None else F.col(k) for k in self.keys]
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")

    def _reaching_back(self, batch: DataFrame, m: dict, first: dict) -> set[int]:
        """Buckets in which a batch row starts at or before the open row of its key."""
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        opened = self._frame(m, [(m["open"][b], "open", b) for b in first if b in m["open"]], batch.sparkSession).select(*self.keys, self.start)
        newest = dict(opened.groupBy(self._bucket(schema).alias("b")).agg(F.max(self.start)).collect())      # one row a bucket
        near = [b for b, t in first.items() if t is not None and newest.get(b) is not None and not t > newest[b]]
        if not near:
            return set()
        kind = schema[self.start].dataType
        early = (batch.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in self.keys], F.col(self.batch_start).cast(kind).alias("_from"))
                 .groupBy(*self.keys).agg(F.min("_from").alias("_from")))
        back = opened.join(early, on=self.keys).where(F.col("_from") <= F.col(self.start))
        return {r[0] for r in back.select(self._bucket(schema)).distinct().collect()}                          # at most all buckets

    def merge(self, batch: DataFrame, batch_id: int, load: Callable) -> dict:
        """Apply ``load(target rows, batch)`` to the buckets the batch reaches; its result
        is their new content.  ``target rows`` is None for the first batch of the table.

        Returns {"batch": {"rows": rows of the batch}}, {} for an empty one.  ``load`` may return
        (content, {name: Observation}); their values are returned too.  Such a load
        must not start Spark jobs of its own, since an Observation holds for the first job.
        """
        before = [v for v in self.versions() if v < batch_id]
        m = self.manifest(before[-1]) if before else None
        schema = T.StructType.fromJson(json.loads(m["schema"])) if m else None
        first = F.min(F.col(self.batch_start).cast(schema[self.start].dataType) if schema else F.col(self.batch_start)) if self.start else F.lit(None)
        reached = batch.groupBy(self._bucket(schema).alias("b")).agg(first, F.count(F.lit(1))).collect()        # one row a bucket
        if not reached:
            return {}
        touched, rows = {r[0]: r[1] for r in reached}, sum(r[2] for r in reached)
        target, replaced = None, set()
        if m:
            if self.start:
                replaced = self._reaching_back(batch, m, touched)
            replaced |= {b for b in touched if len(m["closed"].get(b, [])) >= self.compact_after}
            files = [(m["open"][b], "open", b) for b in touched if b in m["open"]]
            files += [(v, "closed", b) for b in replaced for v in m["closed"].get(b, [])]
            target = self._frame(m, files, batch.sparkSession)           # foreachBatch has a session of its own: one for all of a plan
        got = load(target, batch)
        content, seen = got if isinstance(got, tuple) else (got, {})
        opened = F.coalesce(F.expr(self.open_when), F.lit(False)) if self.open_when else F.lit(True)
        out = content.withColumns({"_state": F.when(opened, "open").otherwise("closed"), "_bucket": self._bucket(None)})
        folder = f"{self.root}/v={batch_id}"
        # rows of a bucket meet in few files; AQE splits a bucket that is too large for one task
        out.hint("rebalance", F.col("_state"), F.col("_bucket")).write.mode("overwrite").partitionBy("_state", "_bucket").parquet(folder)
        written = {s: {int(n.split("=")[1]) for n in commits.names(self.spark, f"{folder}/_state={s}") if "=" in n} for s in STATES}
        new = {"batch": batch_id, "schema": content.schema.json(),
               "open": {b: v for b, v in (m["open"] if m else {}).items() if b not in touched} | {b: batch_id for b in written["open"]},
               "closed": {b: v for b, v in (m["closed"] if m else {}).items() if b not in replaced}}
        for b in written["closed"]:
            new["closed"][b] = [*new["closed"].get(b, []), batch_id]
        commits.write(self.spark, f"{self.root}/_manifest", batch_id, new)
        self._expire(batch_id)
        return {"batch": {"rows": rows}, **{k: obs.get for k, obs in seen.items()}}

    def _expire(self, batch_id: int) -> None:
        have = [v for v in self.versions() if v <= batch_id]
        kept, old = have[-self.keep:], have[:-self.keep]
        named = set().union(*(self._files(self.manifest(v)) for v in kept))
        for v in old:
            for f in self._files(self.manifest(v)) - named:
                commits.remove(self.spark, self._leaf(*f), recursive=True)
            commits.remove(self.spark, f"{self.root}/_manifest/{v}.json")

    def loader(self, load: Callable, on_commit: Callable[[int, dict], None] | None = None) -> Callable:
        """A foreachBatch function.  ``on_commit(batch_id, metrics)`` runs after the merge (and again if the batch is replayed)."""
        def fn(batch: DataFrame, batch_id: int) -> None:
            metrics = self.merge(batch, batch_id, load)
            if on_commit is not None:
                on_commit(batch_id, metrics)
        return fn

    def seed(self, rows: DataFrame) -> None:
        """Make ``rows`` the table before the first batch (version -1)."""
        if self.versions():
            raise ValueError("the table has batches already")
        same = BucketedTable(self.spark, self.root, self.keys, self.buckets, self.open_when, self.start)
        same.merge(rows, -1, lambda _, b: b)
