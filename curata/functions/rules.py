"""Data-quality rules as Column expressions.

A rule is a dict.  ``violation(rule)`` returns a boolean Column that is true
when the row breaks the rule (never null).  Nulls are the null check's job:
every other check treats a null value as passing.

Fixed values:
  default special-character pattern  [^a-zA-Z0-9]
  range rule types (split checks)    lower_than, higher_than, invalid_range, valid_range, mandatory
  range operators (table rules)      <  >  between  not between  <>  =
  label prefixes                     Passed_  Failed_
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPECIAL = "[^a-zA-Z0-9]"


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def _nz(c: Column) -> Column:
    """null -> False."""
    return F.coalesce(c, F.lit(False))


def _range_rule(c: Column, r: dict) -> Column:
    kind = r["type"]
    if kind == "lower_than":
        return c < F.lit(r["threshold"])
    if kind == "higher_than":
        return c > F.lit(r["threshold"])
    if kind == "invalid_range":        # values inside the invalid range fail
        lo, hi = r["range"]
        return c.between(F.lit(lo), F.lit(hi))
    if kind == "valid_range":          # values outside the valid range fail
        lo, hi = r["range"]
        return (c < F.lit(lo)) | (c > F.lit(hi))
    if kind == "mandatory":
        return c.isNull()
    raise ValueError(f"unknown range rule {kind!r}")


def column_violation(rule: dict, col: str) -> Column:
    """Violation of one column under one check (split-check semantics)."""
    t = rule["type"]
    c = F.col(col)
    if t in ("null_check", "orphan_check") and not rule.get("related"):
        return c.isNull()
    if t == "orphan_check":
        return c.isNull() | F.col(rule["helper"][col]).isNull()
    if t == "range_check":
        return _any([_nz(_range_rule(c, r)) for r in rule["rules"]])
    if t == "unique_check":
        return _nz(F.col(rule["helper"][col]))
    if t == "datatype_check":
        return c.isNotNull() & c.try_cast(rule["datatype"]).isNull()
    if t == "special_character_check":
        return _nz(c.rlike(rule.get("pattern", SPECIAL)))
    if t == "date_format_check":
        return c.isNotNull() & F.try_to_timestamp(c, F.lit(rule["format"])).isNull()
    if t == "fixed_length_check":
        return _nz(F.length(c) != F.lit(rule["length"]))
    if t == "valid_values_check" and rule.get("values_from") is not None:
        return c.isNotNull() & F.col(rule["helper"][col]).isNull()
    if t == "valid_values_check":
        return _nz(~c.isin(list(rule["valid_values"])))
    raise ValueError(f"unknown check type {t!r}")


def violation(rule: dict) -> Column:
    """Any listed column breaks the check."""
    cols = rule.get("columns") or [None]
    if rule["type"] == "unique_check":
        return column_violation(rule, cols[0])
    return _any([column_violation(rule, c) for c in cols])


def reason(rule: dict) -> str:
    return f"{rule['type']}:{','.join(rule.get('columns') or [])}"


# ------------------------------------------------------------ table rules
def _typeof_base(c: Column) -> Column:
    return F.lower(F.split(F.typeof(c), r"\(").getItem(0))


def range_violation(c: Column, op: str, low, high=None, mode: str = "valid_if") -> Column:
    """``valid_if``: the operator states the valid condition (flag when it
    does not hold).  ``flag_if``: ``<``, ``>`` and ``between`` state the bad
    condition; ``not between``, ``<>`` and ``=`` state the good one."""
    lo, hi = F.lit(low), F.lit(high)
    good = {"<": c < lo, ">": c > lo, "between": c.between(lo, hi), "not between": ~c.between(lo, hi),
            "<>": c != lo, "=": c == lo}
    if op not in good:
        raise ValueError(f"unknown range operator {op!r}")
    if mode == "valid_if" or op in ("not between", "<>", "="):
        return _nz(~good[op])
    return _nz(good[op])


def table_rule_violation(rule: dict, mode: str = "valid_if") -> Column:
    """Rule rows of a rule catalog (one column each)."""
    t = rule["rule_type"]
    c = F.col(rule["column"])
    if t == "null_check":
        return c.isNull()
    if t == "range_check":
        return range_violation(c, rule["operator"], rule.get("low"), rule.get("high"), mode)
    if t == "orphan_check":
        return F.col(rule["helper"]).isNull()
    if t == "unique_check":
        return _nz(F.col(rule["helper"]))
    if t == "datatype_check":
        return _nz(_typeof_base(c) != F.lit(rule["expected"].lower()))
    if t == "special_character_check":
        return _nz(F.regexp_replace(c, rule.get("pattern", SPECIAL), "") != c)
    if t == "date_format_check":
        return F.try_to_timestamp(F.coalesce(c, F.lit("")), F.lit(rule["format"])).isNull() & c.isNotNull()
    if t == "fixed_length_check":
        return _nz(F.length(c) > F.lit(rule["length"]))
    if t == "valid_values_check" and rule.get("values_from") is not None:
        return c.isNotNull() & F.col(rule["helper"]).isNull()
    if t == "valid_values_check":
        return _nz(~c.isin(list(rule["valid_values"])))
    raise ValueError(f"unknown rule type {t!r}")


def label(rule: dict, violated: Column) -> Column:
    return F.concat(F.when(violated, F.lit("Failed_")).otherwise(F.lit("Passed_")), F.lit(rule["column"]))
