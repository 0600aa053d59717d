"""Load-type switch: append / update / complete (full refresh) / scd2 / full_compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scd
from .dedupe import latest_per_key

TYPES = ("append", "update", "complete", "scd2", "full_compare")


def _as_versions(batch: DataFrame, start: str) -> DataFrame:
    """Batch rows as versions: start_time from ``start``, not deleted."""
    more = {}
    if "start_time" not in batch.columns:
        more["start_time"] = F.col(start)
    if "is_deleted" not in batch.columns:
        more["is_deleted"] = F.lit(0)
    return batch.withColumns(more) if more else batch


def apply_load(load_type: str, target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
               order: Sequence, ties: Sequence = (), as_of=None, start_cols: Sequence = (),
               compare: Sequence[str] | None = None) -> DataFrame:
    """New table content for one load.

    * append       -- target rows plus every batch row
    * update       -- type-1 upsert of the newest batch row per key
    * complete     -- the table is cleared and replaced by the de-duplicated batch
    * scd2         -- every batch row becomes a version from its first order column on
    * full_compare -- the newest batch row per key is the full snapshot: changed and
      new keys get a version from greatest(``start_cols``, by default the first
      order column), keys that are gone are closed and marked deleted at ``as_of``
    """
    kind = (load_type or "").lower()
    if kind not in TYPES:
        raise ValueError(f"unknown load type {load_type!r} ({', '.join(TYPES)})")
    if kind == "append":
        return batch if target is None else target.unionByName(batch, allowMissingColumns=True)
    if kind == "scd2":
        versions = _as_versions(batch, order[0])
        if target is None:
            return scd.scd2_first_load(versions, keys, "start_time", ties)
        return scd.scd2_versions(target, versions, keys, "start_time", ties)
    latest = latest_per_key(batch, keys, order, ties)
    if kind == "update":
        return latest if target is None else scd.scd1_full_join(target, latest, keys)
    if kind == "complete":
        return latest
    starts = list(start_cols) or [order[0]]
    if target is None:
        cols = [F.col(c) if isinstance(c, str) else c for c in starts]
        return latest.withColumns({
            "start_time": F.greatest(*cols) if len(cols) > 1 else cols[0], "is_deleted": F.lit(0),
            "end_time": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(1)})
    if as_of is None:
        raise ValueError("full_compare needs as_of, the time at which gone keys are closed")
    return scd.scd2_full_compare(target, latest, keys, starts, as_of, compare)
