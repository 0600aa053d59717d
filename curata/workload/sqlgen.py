"""Small helpers that write the DuckDB side of the oracle with the same
encodings the Spark operators use."""

from __future__ import annotations

SEP = "chr(31)"
NULL_MARK = "chr(1)"


def enc(col: str, kind: str = "str", scale: int = 6) -> str:
    """DuckDB text of one value, as curata.functions.hashing.encode."""
    if kind == "double":
        fixed = f"TRY_CAST({col} + 0.0 AS DECIMAL(38,{scale}))"
        txt = (f"CASE WHEN CAST({fixed} AS DOUBLE) = {col} THEN CAST({fixed} AS VARCHAR) "
               f"ELSE '~' || CAST({col} AS VARCHAR) END")
    else:
        txt = f"CAST({col} AS VARCHAR)"
    return f"coalesce({txt}, {NULL_MARK})"


def md5_of(cols: list[tuple[str, str]], scale: int = 6) -> str:
    return f"md5(concat_ws({SEP}, {', '.join(enc(c, k, scale) for c, k in cols)}))"


def distinct_any(cols, left="s", right="t") -> str:
    return " OR ".join(f"{left}.{c} IS DISTINCT FROM {right}.{c}" for c in cols)
