"""Change data capture: split by operation, remove deleted keys, apply."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import latest_per_key
from .scd import scd1_full_join


@dataclass
class ChangeFrame:
    """A CDC transaction frame with its column roles."""

    df: DataFrame
    ids: Sequence[str]
    op_col: str = "op"
    ts_col: str = "ts"
    insert_val: str = "insert"
    update_val: str = "update"
    delete_val: str = "delete"
    values: list = field(default_factory=list)

    def __post_init__(self):
        self.ids = list(self.ids)           # own copy: never aliased to the caller's list
        if not self.values:
            skip = set(self.ids) | {self.op_col, self.ts_col}
            self.values = [c for c in self.df.columns if c not in skip]

    def _op(self, val) -> DataFrame:
        return self.df.where(F.col(self.op_col) == F.lit(val))

    def inserts(self) -> DataFrame:
        return self._op(self.insert_val)

    def updates(self) -> DataFrame:
        return self._op(self.update_val)

    def deletes(self) -> DataFrame:
        return self._op(self.delete_val)


def remove_deleted(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop from the target every key present in the delete set."""
    return target.join(deletes.select(*keys), on=list(keys), how="left_anti")


def apply_changes(target: DataFrame, changes: ChangeFrame, order: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """New target after a change batch: per key the newest change wins; a
    delete removes the key, anything else upserts the row (op dropped)."""
    latest = latest_per_key(changes.df, changes.ids, order, ties)
    # one full join: the de-duplicated changes are computed once
    return scd1_full_join(target, latest, changes.ids, delete_if=(changes.op_col, changes.delete_val))


def handle_deletes(df: DataFrame, action_col: str = "ACTION", delete_val: str = "DELETE",
                   keys: Sequence[str] | None = None, target: DataFrame | None = None):
    """Rows marked as deletes leave the batch; with a target and keys, the
    deleted keys are also removed from it.  Returns (batch, target)."""
    deletes = df.where(F.upper(F.col(action_col)) == delete_val)
    rest = df.where(~(F.upper(F.col(action_col)) == delete_val) | F.col(action_col).isNull())
    if target is not None and keys:
        target = remove_deleted(target, deletes, keys)
    return rest, target
