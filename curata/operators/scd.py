"""Slowly-changing-dimension loads as pure functions: (target, source) -> new target.

Parquet tables have no row-level MERGE, so each load returns the complete new
snapshot, which the caller publishes (see ``sources.sinks.publish_snapshot``).
Only the open rows and the batch go through a shuffle.  Type-2 loads first test
whether any batch row reaches back to before its key's open row; if none does, closed
history passes through untouched, else only the closed rows of those keys join in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CONTROL_COLUMNS, as_of_col
from ..functions.compare import columns_differ
from .dedupe import latest_per_key, one_per_key, versions_per_key


def _cols(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


# --------------------------------------------------------------------- type 1
def scd1_full_join(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   action_col: str | None = None, delete_if: tuple[str, object] | None = None) -> DataFrame:
    """Type-1 upsert as one full join on the keys: each input is read once.

    Per key the source row wins, else the target row stays; columns that only
    the target has keep their value, columns of both have the target's type.
    With
    ``delete_if=(column, value)`` a source row whose column equals the value
    removes its key instead, and that column is left out of the result.  Use
    this form when the source is expensive to recompute (e.g. freshly
    de-duplicated): its exchange on the keys serves the join, and a target
    bucketed by the keys is not shuffled at all.
    """
    keys = list(keys)
    drop = {delete_if[0]} if delete_if else set()
    wide = {f.name: f.dataType for f in target.schema.fields}
    source = source.withColumns({k: F.col(k).cast(wide[k]) for k in keys})      # compare keys in the target's type
    tcols = [c for c in target.columns if c not in keys]
    scols = [c for c in source.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in tcols], F.lit(True).alias("_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in scols], F.lit(True).alias("_s"))
    j = t.join(s, on=keys, how="full")
    has_s, has_t = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    if delete_if:
        j = j.where(~(has_s & F.coalesce(F.col(f"_s_{delete_if[0]}") == F.lit(delete_if[1]), F.lit(False))))
    out = [F.col(k) for k in keys]
    for c in dict.fromkeys(tcols + scols):
        if c in drop:
            continue
        if c not in scols:
            out.append(F.col(f"_t_{c}").alias(c))
            continue
        dtype = (target.schema[c] if c in tcols else source.schema[c]).dataType
        sv = F.col(f"_s_{c}").cast(dtype)
        out.append((F.when(has_s, sv).otherwise(F.col(f"_t_{c}")) if c in tcols else sv).alias(c))
    if action_col:
        out.append(F.when(has_s & has_t, "UPDATE").when(has_s, "INSERT").otherwise("KEEP").alias(action_col))
    return j.select(*out)


def scd1(target: DataFrame, source: DataFrame, keys: Sequence[str],
         update: Sequence[str] | None = None, insert: Sequence[str] | None = None,
         action_col: str | None = None) -> DataFrame:
    """Type-1 upsert.

    Without column lists: update all / insert all = target rows whose key is
    not in the source, plus every source row (anti join + union; the anti
    join's build side is the batch, which AQE broadcasts when its measured
    size allows).  With ``update`` / ``insert`` lists (mapped merge): matched
    rows take only the update columns from the source, unlisted target
    columns keep their value; new rows fill only the insert columns.
    """
    keys = list(keys)
    if update is None and insert is None:
        kinds = {f.name: f.dataType for f in target.schema.fields}
        src = source.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds and source.schema[c].dataType != kinds[c]
                              else F.col(c) for c in source.columns])
        kept = target.join(src.select(*keys), on=keys, how="left_anti")
        own = [c for c in target.columns if c not in source.columns]      # what only the target has stays
        if own:
            src = src.join(target.select(*keys, *own), on=keys, how="left")
        if action_col:
            kept = kept.withColumn(action_col, F.lit("KEEP"))
            m = target.select(*keys, F.lit(True).alias("_m"))
            src = (src.join(m, on=keys, how="left")
                   .withColumn(action_col, F.when(F.col("_m"), "UPDATE").otherwise("INSERT")).drop("_m"))
        return kept.unionByName(src, allowMissingColumns=True)
    update = list(update or [])
    insert = list(insert or [])
    tcols = target.columns
    s = source.select(*keys, *[c for c in dict.fromkeys(update + insert) if c not in keys],
                      F.lit(True).alias("_s"))
    t = target.select(*tcols, F.lit(True).alias("_t"))
    j = t.alias("t").join(s.alias("s"), on=keys, how="full")
    matched = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    new = F.col("t._t").isNull()
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
            continue
        tv = F.col(f"t.{c}")
        upd = F.when(matched, F.col(f"s.{c}")).otherwise(tv) if c in update else tv
        ins = F.col(f"s.{c}") if c in insert else F.lit(None).cast(target.schema[c].dataType)
        out.append(F.when(new, ins).otherwise(upd).alias(c))
    if action_col:
        out.append(F.when(new, "INSERT").when(matched, "UPDATE").otherwise("KEEP").alias(action_col))
    return j.select(*out)


def scd1_latest(target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Sequence,
                ties: Sequence = (), timestamp_col: str | None = None, as_of=None,
                except_columns: Sequence[str] = ()) -> DataFrame:
    """Type-1 upsert of the newest source row per key, control columns removed.

    ``timestamp_col`` stamps the load time, ``except_columns`` are dropped;
    with no target (first load) the newest rows are the table.
    """
    latest = latest_per_key(source, keys, order, ties)
    latest = _drop_existing(latest, list(CONTROL_COLUMNS) + list(except_columns))
    if timestamp_col:
        latest = latest.withColumn(timestamp_col, as_of_col(as_of))
    if target is None:
        return latest
    target = _drop_existing(target, list(CONTROL_COLUMNS) + list(except_columns))
    # the de-duplicated batch is read once: one full join instead of anti join + union
    return scd1_full_join(target, latest, keys)


# --------------------------------------------------------------------- type 2
def scd2_first_load(source: DataFrame, keys: Sequence[str], start: str, ties: Sequence = (),
                    end_col: str = "end_time", current_col: str = "is_current", skew: str | bool | dict = "auto") -> DataFrame:
    """All versions kept, newest current, the others closed at the next start."""
    return versions_per_key(source, keys, start, ties, end_col, current_col, version_col=None, skew=skew)


def _split_open(target: DataFrame, current_col: str, deleted_col: str | None):
    open_cond = F.col(current_col) == 1
    if deleted_col and deleted_col in target.columns:
        open_cond = open_cond & (F.col(deleted_col) == 0)
    return target.where(open_cond), target.where(~open_cond)


def scd2(target: DataFrame, source: DataFrame, keys: Sequence[str], start: str,
         compare: Sequence[str] | None = None, skip_unchanged: bool = True,
         end_col: str = "end_time", current_col: str = "is_current",
         deleted_col: str | None = "is_deleted") -> DataFrame:
    """Type-2 upsert of one row per key.

    Open target rows of changed keys close at the new row's start; the new
    row is appended open.  Only open rows close (closed history is never
    touched).  Unchanged keys are skipped unless ``skip_unchanged=False``.
    A source row older than the open row takes its place in the key's history:
    it ends where the next row starts, a closed row that reached over its
    start now ends there, and the open row stays current.  A version that the
    history already has (same start and values) is not added again.  A source
    with a repeated key is refused when the result is computed.
    """
    keys = list(keys)
    batch, source = source, one_per_key(source, keys)
    tcols = target.columns
    vals = list(compare) if compare is not None else [
        c for c in source.columns if c not in set(keys) | set(CONTROL_COLUMNS) | {start}]
    opened, closed = _split_open(target, current_col, deleted_col)
    src = source.select(*[c for c in tcols if c in source.columns])
    for c in tcols:
        if c not in src.columns:
            src = src.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    src = src.select(*tcols).withColumn("_s", F.lit(True))
    o = opened.withColumn("_t", F.lit(True))
    j = o.alias("t").join(src.alias("s"), on=keys, how="full")
    has_t, has_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    diff = columns_differ(vals, "s", "t") if skip_unchanged else F.lit(True)
    late = has_t & has_s & (F.col(f"s.{start}") < F.col(f"t.{start}"))
    change = has_t & has_s & diff & ~late

    def row(alias, overrides: dict):
        return F.struct(*[(overrides[c] if c in overrides else F.col(c) if c in keys else F.col(f"{alias}.{c}")).alias(c)
                          for c in tcols])

    closed_t = row("t", {end_col: F.col(f"s.{start}"), current_col: F.lit(0)})
    new_s = row("s", {end_col: F.lit(None).cast(target.schema[end_col].dataType), current_col: F.lit(1)})
    late_s = row("s", {end_col: F.col(f"t.{start}"), current_col: F.lit(0)})
    rows = F.array(
        F.when(has_t & ~change, row("t", {})),
        F.when(change, closed_t),
        F.when(change | (has_s & ~has_t), new_s),
        F.when(late & diff, late_s),
    )
    kinds = F.array(F.when(has_t & ~change, 0), F.when(change, 0), F.when(change | (has_s & ~has_t), 0), F.when(late & diff, 1))
    pairs = F.arrays_zip(rows.alias("row"), kinds.alias("late"))
    merged = j.select(F.explode(F.filter(pairs, lambda x: x["row"].isNotNull())).alias("p")).select("p.row.*", F.col("p.late").alias("_late"))
    late_keys = _late_keys(opened, batch, keys, start) if _reaches_back(target, batch, start) else None
    if late_keys is None:
        return closed.unionByName(merged.drop("_late"))
    return _settle_late(closed, merged, late_keys, keys, start, vals, end_col)


def _reaches_back(target: DataFrame, src: DataFrame, start: str) -> bool:
    """Whether some ``src`` row starts at or before the newest start of the target: two
    aggregates, which settle most loads."""
    first = src.agg(F.min(F.col(start).cast(target.schema[start].dataType))).first()[0]
    newest = target.agg(F.max(start)).first()[0]
    return first is not None and newest is not None and first <= newest


def _late_keys(opened: DataFrame, src: DataFrame, keys: list[str], start: str) -> DataFrame | None:
    """Distinct keys of ``src`` rows that do not start after their key's open row, staged
    as files of known size; None when there is none, so closed history need not be read.
    Keys and starts alone are joined, once."""
    from ..sources.sinks import staged
    early = src.groupBy(*keys).agg(F.min(F.col(start).cast(opened.schema[start].dataType)).alias("_from"))
    late = opened.select(*keys, F.col(start).alias("_open")).join(early, on=keys).where("_from <= _open").select(*keys).distinct()
    late = staged(late, "late-keys")
    return None if late.isEmpty() else late


def _settle_late(closed: DataFrame, merged: DataFrame, late_keys: DataFrame, keys: list[str], start: str,
                 vals: Sequence[str], end_col: str) -> DataFrame:
    """Fit late rows (_late = 1) into the histories of their keys: closed rows
    of those keys join the timeline, repeats go, ends stop at the next start.
    Closed rows of all other keys pass through."""
    cols = closed.columns
    old = closed.join(late_keys, on=keys, how="left_semi").withColumn("_late", F.lit(0))
    rest = closed.join(late_keys, on=keys, how="left_anti")
    same = Window.partitionBy(*keys, start, *vals)
    line = Window.partitionBy(*keys).orderBy(F.col(start).asc(), F.col("_late").desc())
    t = old.unionByName(merged).withColumn("_kept", F.min("_late").over(same))
    t = t.where((F.col("_late") == 0) | (F.col("_kept") == 1))           # a late row that the history already has goes
    nxt, after_late = F.lead(start).over(line), F.lead("_late").over(line) == 1
    cut = (F.col("_late") == 1) | (after_late & (F.col(end_col) > nxt))
    end = F.when(F.coalesce(cut, F.lit(False)), nxt).otherwise(F.col(end_col)).cast(closed.schema[end_col].dataType)
    return rest.unionByName(t.withColumn("_end", end).withColumn(end_col, F.col("_end")).select(*cols))


def scd2_versions(target: DataFrame, source: DataFrame, keys: Sequence[str], start: str,
                  ties: Sequence = (), end_col: str = "end_time", current_col: str = "is_current",
                  deleted_col: str | None = "is_deleted", skew: str | bool | dict = "auto") -> DataFrame:
    """Type-2 upsert of a multi-version batch in one pass.

    The open target rows and the batch rows form one timeline per key: a
    single window over their union gives every row the next row's start as
    its end, and the newest row stays open.  So the open row closes at the
    batch's earliest start, batch versions close at each other's starts, and
    a batch row older than the open row slots in before it.  Where the batch
    reaches back to or before the open start of a key, that key's closed rows
    join the timeline (they only ever end earlier), so intervals never overlap;
    a version that the history already has is not added again.  Other closed
    history passes through.
    """
    keys = list(keys)
    tcols = target.columns
    opened, closed = _split_open(target, current_col, deleted_col)
    src = source.select(*[c for c in source.columns if c in tcols])
    for c in tcols:
        if c not in src.columns and c not in (end_col, current_col):
            src = src.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    base = [c for c in tcols if c not in (end_col, current_col)]
    late_keys = None
    if _reaches_back(target, src, start):
        from ..sources.sinks import staged_once
        target, src = staged_once(target, "history"), staged_once(src, "batch")      # each is read several times from here on
        opened, closed = _split_open(target, current_col, deleted_col)
        late_keys = _late_keys(opened, src, keys, start)
    mark = [F.lit(None).cast(target.schema[end_col].dataType).alias("_was"), F.lit(False).alias("_closed")]
    timeline = opened.select(*base, *mark)
    if late_keys is not None:
        old = closed.join(late_keys, on=keys, how="left_semi")
        timeline = timeline.unionByName(old.select(*base, F.col(end_col).alias("_was"), F.lit(True).alias("_closed")))
        closed = closed.join(late_keys, on=keys, how="left_anti")
    timeline = timeline.withColumn("_new", F.lit(0)).unionByName(src.select(*base, *mark, F.lit(1).alias("_new")))
    # repeats of a version: the target's row stays, else one of the batch's
    vals = [c for c in base if c not in CONTROL_COLUMNS or c == start]
    v = versions_per_key(timeline, keys, start, ties, end_col, current_col, version_col=None, skew=skew, repeats=("_new", vals))
    end = F.when(F.col("_closed"), F.least("_was", end_col)).otherwise(F.col(end_col))
    v = v.withColumn("_end", end.cast(target.schema[end_col].dataType)).withColumn(end_col, F.col("_end"))
    v = v.withColumn(current_col, F.when(F.col("_closed"), 0).otherwise(F.col(current_col)).cast(target.schema[current_col].dataType))
    return closed.unionByName(v.select(*tcols))


def scd2_full_compare(target: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                      start_cols: Sequence, as_of, compare: Sequence[str] | None = None,
                      start_col: str = "start_time", end_col: str = "end_time",
                      current_col: str = "is_current", deleted_col: str = "is_deleted") -> DataFrame:
    """Full-snapshot type-2 load against the open rows of the target.

    Changed keys: open row closed at ``as_of``, snapshot row inserted with
    start = greatest(start_cols).  New keys: inserted.  Keys missing from the
    snapshot: soft-deleted (is_current=0, is_deleted=1, end = as_of).
    Identical keys: untouched.  A snapshot with a repeated key is refused
    when the result is computed.
    """
    keys = list(keys)
    snapshot = one_per_key(snapshot, keys)
    t_as_of = as_of_col(as_of)
    tcols = target.columns
    data_cols = [c for c in tcols if c not in set(keys) | set(CONTROL_COLUMNS)]
    vals = list(compare) if compare is not None else data_cols
    opened, closed = _split_open(target, current_col, deleted_col)
    starts = [_cols(c) for c in start_cols]
    s = snapshot.select(*keys, *data_cols,
                        (F.greatest(*starts) if len(starts) > 1 else starts[0]).alias("_start"),
                        F.lit(True).alias("_s"))
    o = opened.withColumn("_t", F.lit(True))
    j = o.alias("t").join(s.alias("s"), on=keys, how="full")
    has_t, has_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    changed = has_t & has_s & columns_differ(vals, "s", "t")
    end_type = target.schema[end_col].dataType

    def row(alias, overrides: dict):
        exprs = []
        for c in tcols:
            if c in overrides:
                e = overrides[c]
            elif c in keys:
                e = F.col(c)
            else:
                e = F.col(f"{alias}.{c}")
            exprs.append(e.cast(target.schema[c].dataType).alias(c))
        return F.struct(*exprs)

    overrides_ctl = {c: F.lit(None) for c in CONTROL_COLUMNS if c in tcols and c not in
                     (start_col, end_col, current_col, deleted_col)}
    new_row = row("s", {**overrides_ctl, start_col: F.col("s._start"), end_col: F.lit(None).cast(end_type),
                        current_col: F.lit(1), deleted_col: F.lit(0)})
    rows = F.array(
        F.when(has_t & has_s & ~changed, row("t", {})),
        F.when(changed, row("t", {end_col: t_as_of, current_col: F.lit(0)})),
        F.when(changed | (has_s & ~has_t), new_row),
        F.when(has_t & ~has_s, row("t", {end_col: t_as_of, current_col: F.lit(0), deleted_col: F.lit(1)})),
    )
    merged = j.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))
    return closed.unionByName(merged)


def current_rows(history: DataFrame, current_col: str = "is_current", deleted_col: str | None = "is_deleted") -> DataFrame:
    """Current-row view of a history table."""
    cond = F.col(current_col) == 1
    if deleted_col and deleted_col in history.columns:
        cond = cond & (F.col(deleted_col) == 0)
    return history.where(cond)


def current_by_validity(history: DataFrame, through_col: str = "valid_through_date", open_end=None) -> DataFrame:
    """Current rows of a validity-interval dimension (open end)."""
    from ..constants import OPEN_END
    return history.where(F.col(through_col) == F.lit(open_end or OPEN_END).cast(history.schema[through_col].dataType))
