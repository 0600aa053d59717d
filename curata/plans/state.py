"""Loads that remember how far they got: initial flag, watermark and snapshot.

A load's state is one record per load under ``<root>/_state``: which snapshot the
table is, whether the initial load is done, and the newest change it has taken.
The snapshot is written first, then the record is committed by a rename, so flag,
watermark and content advance together or not at all.  A failed load leaves the
state before it and a folder that nothing names; running it again reads the same
increment.  Two loads that started from one state cannot both commit.

config = {"source": {"source_table_type": ..., "initial_filepath": ..., "delta_filepath": ..., ...},
          "change_col": "...", "steps": [...], "load": {...}}
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import commits
from ..sources.files import initial_or_delta_path
from . import loader
from . import steps as step_mod


@dataclass(frozen=True)
class LoadState:
    """``number`` 0: never loaded.  ``watermark`` is the newest change as text."""
    number: int = 0
    is_initial_completed: bool = False
    watermark: str | None = None
    snapshot: str | None = None
    rows_loaded: int = 0


def current(spark: SparkSession, root: str) -> LoadState:
    """The last committed state of a load."""
    have = commits.numbers(spark, f"{root.rstrip('/')}/_state")
    return LoadState(**commits.read(spark, f"{root.rstrip('/')}/_state", have[-1])) if have else LoadState()


def table(spark: SparkSession, state: LoadState) -> DataFrame | None:
    return None if state.snapshot is None else spark.read.parquet(state.snapshot)


def increment(spark: SparkSession, config: dict, state: LoadState, until: str | None = None) -> DataFrame:
    """What a load in this state reads: the initial folder until the initial load is
    done, then the delta folder's changes after the watermark (up to ``until``)."""
    source = config["source"]
    path = initial_or_delta_path({**source, "is_initial_completed": state.is_initial_completed})
    df = loader.read_source(spark, {**source, "path": path})
    col = config["change_col"]
    if state.is_initial_completed and state.watermark is not None:
        df = df.where(F.col(col) > F.lit(state.watermark).cast(df.schema[col].dataType))
    if until is not None:
        df = df.where(F.col(col) <= F.lit(until).cast(df.schema[col].dataType))
    return df


def run(spark: SparkSession, config: dict, root: str, until: str | None = None, registry: dict | None = None) -> LoadState:
    """One load: read the increment, merge it into the snapshot, commit the new state.
    An increment without rows changes nothing."""
    root = root.rstrip("/")
    state = current(spark, root)
    read = increment(spark, config, state, until)
    # rows and newest change of the increment: one narrow pass, before the merge
    seen = read.agg(F.count(F.lit(1)).alias("n"), F.max(config["change_col"]).cast("string").alias("mark")).first()
    if not seen["n"]:
        return state
    batch, _ = step_mod.run(read, config.get("steps", []), registry)
    new = loader.load_into(config["load"], table(spark, state), batch)
    snapshot = f"{root}/v-{uuid.uuid4().hex[:16]}"
    new.write.parquet(snapshot)
    done = LoadState(state.number + 1, True, seen["mark"] or state.watermark, snapshot, seen["n"])
    commits.write(spark, f"{root}/_state", done.number, done.__dict__, replace=False)
    return done
