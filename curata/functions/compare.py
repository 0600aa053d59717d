"""Null-safe difference predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(left: Column, right: Column) -> Column:
    """True when the values differ, counting null <> value as a change."""
    return ~left.eqNullSafe(right)


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """OR over all pairs (every column counts, nulls included)."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [differs(l, r) for l, r in pairs])


def columns_differ(cols: Sequence[str], left: str, right: str) -> Column:
    """any_differs for the same column names under two aliases."""
    return any_differs([(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in cols])
