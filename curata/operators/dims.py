"""Validity-interval dimensions: type-2 staging/apply, type-1 apply,
staged loads tagged U2 / N2 / N / U1, detail collapse.

Each load compares the increment with the *open* rows (one join on the
business key); of closed rows only the keys are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MIN_DATE, OPEN_END, as_of_col
from ..functions.compare import any_differs
from ..functions.hashing import NULL_MARK, SEP
from .dedupe import one_per_key
from .scd import scd1_full_join


def _ts(v: str) -> Column:
    return F.lit(v).cast("timestamp_ntz")


def open_rows(dim: DataFrame, through: str = "valid_through_date", open_end: str = OPEN_END):
    cond = F.col(through) == _ts(open_end)
    return dim.where(cond), dim.where(~cond)


def _compare(src: DataFrame, dim_open: DataFrame, keys: Sequence[str], tracked: Sequence[str]):
    """src ⟕ open rows: (joined frame, has-open-row, tracked-changed)."""
    o = dim_open.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in tracked], F.lit(True).alias("_open"))
    j = src.join(o, on=list(keys), how="left")
    has = F.col("_open").isNotNull()
    changed = has & any_differs([(F.col(c), F.col(f"_o_{c}")) for c in tracked])
    return j, has, changed


def _key_text(keys: Sequence[str]) -> Column:
    """One text per key: parts separated, nulls marked, so different composite
    keys never share it (a single non-null key is its own text)."""
    return F.concat_ws(SEP, *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_MARK)) for k in keys])


def _merge_token(keys: Sequence[str]) -> Column:
    return _key_text(keys)


def scd2_staging(src: DataFrame, dim: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 merge_key: str = "merge_key") -> DataFrame:
    """Type-2 staging set (``src`` holds one row per key -- see
    ``plans.flows.raw_to_curated``, which de-duplicates an increment first):
    for a tracked change, one row keyed for closing the
    open row ('close') and a copy with a never-matching merge key ('insert');
    keys without any row, open or closed, are new members ('new').  A member
    that has only closed rows is neither."""
    opened, closed = open_rows(dim)
    j, has, changed = _compare(src, opened, keys, tracked)
    # of closed history only the increment's keys matter: the semi join drops the others before any shuffle that
    # a small increment does not need
    known = closed.select(*keys).join(src.select(*keys), on=list(keys), how="left_semi").distinct()
    j = j.join(known.withColumn("_known", F.lit(True)), on=list(keys), how="left")
    fresh = ~has & F.col("_known").isNull()
    cols = src.columns
    key_expr = _merge_token(keys)          # an opaque text token, one form for any key width
    null_key = F.lit(None).cast("string")

    def row(mk, stage):
        return F.struct(mk.alias(merge_key), *[F.col(c).alias(c) for c in cols], F.lit(stage).alias("stage"))

    rows = F.array(F.when(changed, row(key_expr, "close")), F.when(changed, row(null_key, "insert")),
                   F.when(fresh, row(null_key, "new")))
    return j.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def surrogate(prefix: str, keys: Sequence[str], suffix: str | None = None) -> Column:
    parts = [F.lit(prefix), _key_text(keys)]
    if suffix is not None:
        parts += [F.lit("_"), F.lit(suffix)]
    return F.md5(F.concat(*parts))


def scd2_apply(dim: DataFrame, staging: DataFrame, keys: Sequence[str], as_of: str, id_col: str,
               id_prefix: str = "v2_", fixed: dict | None = None, close_gap: str = "INTERVAL 1 SECOND",
               merge_key: str = "merge_key") -> DataFrame:
    """Apply a type-2 staging set in one join: open rows FULL JOIN staging ON
    key = merge_key.  A 'close' row matches its open row, which closes at
    ``as_of - close_gap``; 'insert' and 'new' rows carry a null merge key, never
    match, and are inserted open-ended ('insert' from ``as_of``, 'new' from
    MIN_DATE) with an md5 surrogate of (prefix, key, as_of).  Closed history
    passes through untouched.  The staging set is read once."""
    opened, closed = open_rows(dim)
    t = as_of_col(as_of)
    fixed = fixed or {}
    scols = [c for c in staging.columns if c not in (merge_key, "stage")]
    st = staging.select(F.col(merge_key).alias("_mk"), F.col("stage").alias("_stage"),
                        *[F.col(c).alias(f"_s_{c}") for c in scols])
    okey = _merge_token(keys)
    o = opened.withColumn("_ok", okey).withColumn("_open", F.lit(True))
    j = o.join(st, o["_ok"] == st["_mk"], "full")
    has_o = F.col("_open").isNotNull()
    matched = has_o & F.col("_mk").isNotNull()
    new_id = surrogate(id_prefix, [f"_s_{k}" for k in keys], str(as_of))
    out = []
    for c in dim.columns:
        if c == id_col:
            ins = new_id
        elif c in fixed:
            ins = F.lit(fixed[c])
        elif c == "valid_from_date":
            ins = F.when(F.col("_stage") == "new", _ts(MIN_DATE)).otherwise(t)
        elif c == "valid_through_date":
            ins = _ts(OPEN_END)
        elif c in scols:
            ins = F.col(f"_s_{c}")
        else:
            ins = F.lit(None)
        cur = F.col(c)
        if c == "valid_through_date":
            cur = F.when(matched, t - F.expr(close_gap)).otherwise(F.col(c))
        out.append(F.when(has_o, cur).otherwise(ins).cast(dim.schema[c].dataType).alias(c))
    merged = j.where(has_o | F.col("_stage").isin("insert", "new")).select(*out)
    return closed.unionByName(merged)


def scd1_apply(dim: DataFrame, src: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               attributes: Sequence[str]) -> DataFrame:
    """Members without a tracked change overwrite the attributes of their
    open row (a null source value keeps the old one)."""
    opened, closed = open_rows(dim)
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in set(attributes) | set(tracked)],
                   F.lit(True).alias("_src"))
    j = opened.join(s, on=list(keys), how="left")
    hit = F.col("_src").isNotNull() & ~any_differs([(F.col(c), F.col(f"_s_{c}")) for c in tracked])
    j = j.withColumns({c: F.when(hit, F.coalesce(F.col(f"_s_{c}"), F.col(c))).otherwise(F.col(c)) for c in attributes})
    return closed.unionByName(j.select(*dim.columns))


def new_members(src: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increment rows whose key has no dimension row, open or closed (anti join)."""
    return src.join(dim.select(*keys), on=list(keys), how="left_anti")


def staged_load(src: DataFrame, dim: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str,
                id_col: str, id_prefix: str, fixed: dict | None = None,
                close_gap: str = "INTERVAL 1 MILLISECOND") -> DataFrame:
    """Staging rows tagged with ``load_type`` (``src`` holds one row per key):

    * U2 -- open row of a member whose tracked attributes changed, closed at
      ``as_of - close_gap``
    * N2 -- the new version of that member, valid from ``as_of``
    * N  -- a member without an open row, valid from the last close of its
      closed rows, without any from MIN_DATE
    * U1 -- open row of a member without tracked change, attributes
      overwritten (type 1)

    A repeated key in ``src`` is refused when the result is computed.
    """
    opened, closed = open_rows(dim)
    t = as_of_col(as_of)
    attrs = [c for c in src.columns if c not in keys]
    s = one_per_key(src, keys).select(*keys, *[F.col(c).alias(f"_s_{c}") for c in attrs], F.lit(True).alias("_src"))
    ended = closed.groupBy(*keys).agg(F.max("valid_through_date").alias("_ended"))
    j = opened.alias("o").join(s, on=list(keys), how="full").join(ended, on=list(keys), how="left")
    has_o, has_s = F.col("o." + id_col).isNotNull(), F.col("_src").isNotNull()
    changed = has_o & has_s & any_differs([(F.col(f"o.{c}"), F.col(f"_s_{c}")) for c in tracked])
    new_id = surrogate(id_prefix, keys, str(as_of))
    fixed = fixed or {}

    def row(tag, ident, from_, through, use_src):
        out = []
        for c in dim.columns:
            if c == id_col:
                e = ident
            elif c in keys:
                e = F.col(c)
            elif c in fixed:
                e = F.lit(fixed[c])
            elif c == "valid_from_date":
                e = from_
            elif c == "valid_through_date":
                e = through
            elif use_src and c in attrs:
                e = F.col(f"_s_{c}")
            else:
                e = F.col(f"o.{c}")
            out.append(e.cast(dim.schema[c].dataType).alias(c))
        return F.struct(*out, F.lit(tag).alias("load_type"))

    rows = F.array(
        F.when(changed, row("U2", F.col(f"o.{id_col}"), F.col("o.valid_from_date"), t - F.expr(close_gap), False)),
        F.when(changed, row("N2", new_id, t, _ts(OPEN_END), True)),
        F.when(has_s & ~has_o, row("N", new_id, F.coalesce(F.col("_ended"), _ts(MIN_DATE)), _ts(OPEN_END), True)),
        F.when(has_o & has_s & ~changed, row("U1", F.col(f"o.{id_col}"), F.col("o.valid_from_date"),
                                             F.col("o.valid_through_date"), True)),
    )
    return j.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def staged_merge(dim: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final merge of staged rows on (surrogate key, source system): one full
    join, so the staged set is computed once."""
    return scd1_full_join(dim, staged.drop("load_type"), keys)


def collapse_max(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One member row per key: max of every attribute, plus the row count."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in attributes], F.count(F.lit(1)).alias("n_rows"))


def collapse_json(df: DataFrame, keys: Sequence[str], detail: Sequence[str], name: str = "detail_json") -> DataFrame:
    """Nested detail as JSON: per key, the sorted array of its distinct detail
    combinations with their row counts.

    Rows are counted per (key, detail) first -- a map-side aggregate -- so a
    key's array holds one entry per distinct combination, never one per row.
    """
    per = df.groupBy(*keys, *detail).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*keys).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*detail, "n")))).alias(name))


def collapse_parts(df: DataFrame, keys: Sequence[str], detail: Sequence[str], per_part: int | None = None) -> DataFrame:
    """``collapse_json``'s entries without a bound on a key's detail: (keys, part, entries),
    each part a sorted array of at most ``per_part`` combinations with their counts."""
    from . import lists
    per = df.groupBy(*keys, *detail).agg(F.count(F.lit(1)).alias("n"))
    return lists.parts(per, keys, [*detail, "n"], per_part=per_part or lists.PER_PART)
