"""Delta detection against an existing table: by columns or by hashes.

All comparisons are null-safe.  Joins run on primary keys (or their hash),
which are unique per side once the batch is de-duplicated, so no single key
can hold a large share of rows on either side of these joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compare import columns_differ
from .dedupe import one_per_key


def _value_cols(df: DataFrame, keys: Sequence[str], compare: Sequence[str] | None,
                skip: Sequence[str] = ()) -> list[str]:
    if compare is not None:
        return list(compare)
    return [c for c in df.columns if c not in set(keys) | set(skip)]


def diff_rows(source: DataFrame, target: DataFrame | None, keys: Sequence[str],
              suffix: str = "_target") -> DataFrame:
    """Rows whose values differ from the target by key (either side may be
    missing).  Target values are carried as ``<col><suffix>``.  Without a
    target every source row passes through."""
    if target is None:
        return source
    vals = _value_cols(source, keys, None)
    out = [*source.columns, *[c + suffix for c in vals]]
    in_s, in_t = "in_source" + suffix, "in" + suffix
    t = target.select(*keys, *[F.col(c).alias(c + suffix) for c in vals], F.lit(True).alias(in_t))
    j = source.withColumn(in_s, F.lit(True)).join(t, on=list(keys), how="full")
    cond = F.col(in_s).isNull() | F.col(in_t).isNull()          # on one side only: a difference whatever its values
    for c in vals:
        cond = cond | ~F.col(c).eqNullSafe(F.col(c + suffix))
    return j.where(cond).select(*out)


def classify(source: DataFrame, target: DataFrame, keys: Sequence[str],
             compare: Sequence[str] | None = None, action_col: str = "action",
             skip: Sequence[str] = ()) -> DataFrame:
    """One full join; every key gets NEW / UPDATED / SAME / DELETED.

    Output: keys, the source values (target values for DELETED), action.  A
    source with a repeated key is refused when the result is computed.
    """
    vals = _value_cols(source, keys, compare, skip)
    s = one_per_key(source, keys).select(*keys, *vals, F.lit(True).alias("_s"))
    t = target.select(*keys, *vals, F.lit(True).alias("_t"))
    j = s.alias("s").join(t.alias("t"), on=list(keys), how="full")
    action = (F.when(F.col("t._t").isNull(), "NEW")
              .when(F.col("s._s").isNull(), "DELETED")
              .when(columns_differ(vals, "s", "t"), "UPDATED")
              .otherwise("SAME"))
    out = [F.col(k) for k in keys] + [
        F.when(F.col("s._s").isNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in vals]
    return j.select(*out, action.alias(action_col))


def semi_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose composite key is present in the source."""
    return target.join(source.select(*keys), on=list(keys), how="left_semi")


def subtract_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows not in the target, multiplicity kept (EXCEPT ALL)."""
    return source.exceptAll(target.select(*source.columns))


def hash_delta(existing: DataFrame, incoming: DataFrame, key_col: str = "hkey", diff_col: str = "hdiff",
               flag_col: str = "curr_row_flg") -> DataFrame:
    """Delta set from hashes, one full join on hkey, each key once:

    * changed: existing row -> 'N', incoming row -> 'Y'
    * new: incoming row -> 'Y'
    * gone: existing row -> 'D'
    * unchanged: existing row kept as is ('Y')
    """
    cols = [c for c in incoming.columns if c != flag_col]
    e = existing.select(*cols, F.lit(True).alias("_e"))
    i = incoming.select(*cols, F.lit(True).alias("_i"))
    j = e.alias("e").join(i.alias("i"), F.col(f"e.{key_col}") == F.col(f"i.{key_col}"), "full")
    has_e, has_i = F.col("e._e").isNotNull(), F.col("i._i").isNotNull()
    changed = has_e & has_i & ~F.col(f"e.{diff_col}").eqNullSafe(F.col(f"i.{diff_col}"))

    def side(alias, flag):
        return F.struct(*[F.col(f"{alias}.{c}").alias(c) for c in cols], F.lit(flag).alias(flag_col))

    rows = F.array(
        F.when(changed, side("e", "N")),
        F.when(changed, side("i", "Y")),
        F.when(has_i & ~has_e, side("i", "Y")),
        F.when(has_e & ~has_i, side("e", "D")),
        F.when(has_e & has_i & ~changed, side("e", "Y")),
    )
    return j.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def snapshot_history(old: DataFrame, current: DataFrame, key_col: str = "hkey", diff_col: str = "hdiff",
                     flag_col: str = "curr_row_flg") -> DataFrame:
    """History rows between two snapshots of a hashed table.

    Old rows that were already history ('N'), or whose values changed, get
    'N'; old rows whose key is gone from the current snapshot get 'D'.
    """
    cur = (current.where(F.col(flag_col) == "Y")
           .select(F.col(key_col).alias("_ck"), F.col(diff_col).alias("_cd")))
    j = old.join(cur, F.col(key_col) == F.col("_ck"), "left")
    hist = (F.col(flag_col) == "N") | ((F.col(flag_col) == "Y") & ~F.col(diff_col).eqNullSafe(F.col("_cd")))
    gone = F.col("_ck").isNull()
    return (j.where(hist | gone)
            .withColumn(flag_col, F.when(gone, "D").otherwise("N"))
            .drop("_ck", "_cd"))
