"""End-to-end loads built from the operators.

* ``landing_to_raw`` -- one landed batch (or micro-batch): latest row per key,
  hash keys, data-quality flags, then the load type (update = upsert on the
  key hash, append of every row, complete).  Raw and de-duplicated row counts are gathered
  with ``observe`` while the load itself runs -- no extra jobs.
* ``raw_to_curated`` -- an increment of a raw table into a validity-interval
  dimension: type-2 staging and apply for tracked attributes, type-1 apply for
  the rest, new members, and the watermark row of the load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import compare, dedupe, dims, incremental, quality, scd


def landing_to_raw(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence,
                   ties: Sequence = (), rules: Sequence[dict] = (), load_type: str = "update",
                   hash_exclude: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """New raw table content and the observations {"raw", "dedup", "rules"} (an append
    does not de-duplicate and has no "dedup"; "rules" holds the flagged rows of every rule, by its id)."""
    raw_obs, dedup_obs, rule_obs = Observation(), Observation(), Observation()      # unique names: loads can be chained
    b = batch.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    latest = dedupe.latest_per_key(b, keys, order, ties).observe(dedup_obs, F.count(F.lit(1)).alias("rows"))
    kind = load_type.lower()
    # append keeps every row of the batch; the other load types its newest row per key
    hashed = hashing.hash_keys(b if kind == "append" else latest, keys, exclude=hash_exclude)
    if rules:
        flagged = quality.flag_rules(hashed, rules)
        flagged = flagged.observe(rule_obs, *[F.count_if(F.array_contains("data_quality_result_array", str(r["id"]))).alias(str(r["id"]))
                                              for r in rules])
    else:
        flagged = hashed.withColumns({"data_quality_result_array": F.array().cast("array<string>"),
                                      "data_quality_valid_flag": F.lit("Y")})
    if kind == "update":
        # one full join: the de-duplicated, hashed and flagged batch is computed once
        new = flagged if target is None else scd.scd1_full_join(target, flagged, ["hkey"])
    elif kind == "append":
        new = flagged if target is None else target.unionByName(flagged, allowMissingColumns=True)
    elif kind == "complete":
        new = flagged
    else:
        raise ValueError(f"unknown load type {load_type!r}")
    seen = {"raw": raw_obs} if kind == "append" else {"raw": raw_obs, "dedup": dedup_obs}
    return new, {**seen, "rules": rule_obs} if rules else seen


def landing_history(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence,
                    ties: Sequence = (), hash_exclude: Sequence[str] = (), flag_col: str = "curr_row_flg") -> DataFrame:
    """Raw table content that keeps what a batch replaces.

    The newest row per key is compared with the table's current rows ('Y') by
    key and value hash: new and changed rows come in as 'Y', the rows they
    replace stay as 'N', rows whose key is gone from the batch become 'D', and
    unchanged rows and all earlier history stay as they are.
    """
    latest = hashing.hash_keys(dedupe.latest_per_key(batch, keys, order, ties), keys, exclude=[*hash_exclude, flag_col])
    if target is None:
        return latest.withColumn(flag_col, F.lit("Y"))
    cols = [*latest.columns, flag_col]
    current = target.where(F.col(flag_col) == "Y").select(*latest.columns)
    delta = compare.hash_delta(current, latest, flag_col=flag_col)
    return target.where(F.col(flag_col) != "Y").select(*cols).unionByName(delta.select(*cols))


def raw_to_curated(dim: DataFrame, raw: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                   attributes: Sequence[str], as_of: str, id_col: str, id_prefix: str,
                   fixed: dict | None = None, change_col: str | None = None, window: tuple | None = None,
                   watermark_ids: dict | None = None,
                   checkpoint_staging: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(new dimension, watermark row or None).

    The increment is ``raw`` limited to ``window`` on ``change_col`` (a
    pushed-down predicate).  Members whose tracked attributes changed get a
    new version (the open row closes one second before ``as_of``), new
    members are inserted open-ended, and every other member's open row takes
    the increment's untracked attributes.  Running the same increment twice
    gives the same dimension.  ``checkpoint_staging`` writes the type-2
    staging set to spark.checkpoint.dir (a reliable checkpoint), cutting the
    lineage: a lost executor then re-reads staged files instead of
    recomputing the increment join.
    """
    inc = incremental.window(raw, change_col, *window) if (change_col and window) else raw
    # several changes of one member in the window: its newest row is the one
    # that counts (by change_col; else a deterministic pick by value)
    attrs = list(dict.fromkeys([*tracked, *attributes]))
    inc = dedupe.latest_per_key(inc, keys, [change_col] if change_col else attrs, ties=attrs)
    inc = inc.select(*keys, *attrs)
    staging = dims.scd2_staging(inc, dim, keys, tracked)
    if checkpoint_staging:
        from ..session import checkpoint_root
        checkpoint_root(dim.sparkSession)          # registers a folder only where none is set
        staging = staging.checkpoint(eager=True)
    after2 = dims.scd2_apply(dim, staging, keys, as_of, id_col, id_prefix, fixed)
    after1 = dims.scd1_apply(after2, inc, keys, tracked, attributes)
    mark = None
    if change_col and watermark_ids is not None:
        src = incremental.window(raw, change_col, *window) if window else raw
        mark = incremental.watermark_row(src, change_col, watermark_ids)
    return after1, mark
