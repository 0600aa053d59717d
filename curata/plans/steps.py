"""Step chain: an ordered list of declared transformations.

A step is a dict ``{"op": name, ...arguments}``.  Every op is a DataFrame ->
DataFrame function, so a chain is a fold of ``df.transform`` and Catalyst
sees one plan (filters of later steps still reach the scan).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import as_of_col


def where(df: DataFrame, expr: str) -> DataFrame:
    return df.where(expr)


def select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plain column names or SQL expressions."""
    return df.selectExpr(*columns)


def has_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    """Column presence test (case-insensitive, like Spark's resolver)."""
    present = {c.lower() for c in df.columns}
    return all(c.lower() in present for c in columns)


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def normalize_names(df: DataFrame, chars: str = " /") -> DataFrame:
    """Blanks and '/' in column names become '_'."""
    pat = "[" + re.escape(chars) + "]"
    return df.toDF(*[re.sub(pat, "_", c) for c in df.columns])


def positional_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position (headerless files)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def fillna(df: DataFrame, value="na", columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(columns) if columns else None)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def cast(df: DataFrame, types: dict, safe: bool = False) -> DataFrame:
    """Cast map column -> type; ``safe`` uses try_cast (null instead of an
    ANSI error) so bad values can be quarantined by a later check."""
    if safe:
        return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def add_timestamps(df: DataFrame, as_of, file_time_col: str = "file_modification_time") -> DataFrame:
    """create_date, change_date, src_file_process_time, file time, empty hashes."""
    t = as_of_col(as_of)
    cols = {"create_date": t, "change_date": t, "src_file_process_time": t,
            "hkey": F.lit(""), "hdiff": F.lit("")}
    if file_time_col not in df.columns:
        cols[file_time_col] = F.lit(None).cast("timestamp_ntz")
    return df.withColumns(cols)


def observe_count(df: DataFrame, name: str = "row_count"):
    """Row-count pass-through: the count is gathered by the next action on
    the returned frame, with no extra job.  Returns (df, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def sql(df: DataFrame, text: str, view: str = "table_view", **params) -> DataFrame:
    """SQL over the incoming frame: ``{table_view}`` names it; other
    ``{name}`` placeholders take DataFrames or values from ``params``."""
    return df.sparkSession.sql(text, **{view: df}, **params)


def sql_file(df: DataFrame, path: str, **kw) -> DataFrame:
    with open(path, encoding="utf-8") as fh:
        return sql(df, fh.read(), **kw)


BUILTIN: dict[str, Callable] = {
    "where": lambda df, s, reg: where(df, s["expr"]),
    "select": lambda df, s, reg: select(df, s["columns"]),
    "drop": lambda df, s, reg: drop(df, s["columns"]),
    "rename": lambda df, s, reg: rename(df, s["mapping"]),
    "normalize": lambda df, s, reg: normalize_names(df, s.get("chars", " /")),
    "positional": lambda df, s, reg: positional_names(df, s["names"]),
    "fillna": lambda df, s, reg: fillna(df, s.get("value", "na"), s.get("columns")),
    "distinct": lambda df, s, reg: distinct(df),
    "cast": lambda df, s, reg: cast(df, s["types"], s.get("safe", False)),
    "timestamps": lambda df, s, reg: add_timestamps(df, s["as_of"]),
    "sql": lambda df, s, reg: (sql_file(df, s["file"], **s.get("params", {})) if "file" in s
                               else sql(df, s["text"], **s.get("params", {}))),
    "py": lambda df, s, reg: df.transform(reg[s["name"]], **s.get("args", {})),
}


def run(df: DataFrame, steps: Sequence[dict], registry: dict[str, Callable] | None = None):
    """Apply the steps in order; returns (DataFrame, [step ids])."""
    reg = dict(registry or {})
    done = []
    for i, step in enumerate(steps):
        op = step.get("op")
        if op not in BUILTIN:
            raise ValueError(f"unknown step op {op!r}")
        df = BUILTIN[op](df, step, reg)
        done.append(step.get("id", f"{i}:{op}"))
    return df, done


class StepChain:
    """A growing list of steps (append one or several, length, iteration)."""

    def __init__(self, steps: Sequence[dict] = (), registry: dict[str, Callable] | None = None):
        self.steps = list(steps)
        self.registry = dict(registry or {})

    def add(self, step: dict) -> "StepChain":
        self.steps.append(step)
        return self

    def add_all(self, steps: Sequence[dict]) -> "StepChain":
        self.steps.extend(steps)
        return self

    def __len__(self):
        return len(self.steps)

    def __iter__(self):
        return iter(self.steps)

    def run(self, df: DataFrame):
        return run(df, self.steps, self.registry)
