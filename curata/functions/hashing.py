"""Row hashes with an unambiguous encoding.

Fixed values (the encoding both the loader and an SQL check must share):
  field separator  = chr(31)  (unit separator)
  null marker      = chr(1)
  doubles/floats   = decimal(38, scale) text, scale 6 by default (-0.0 -> 0), where that text
                     stands for exactly the same double; any other value (more digits, out of
                     range, NaN, infinity) = '~' and its shortest text
  row hash for tables without a key: sha2(concat_ws('||', cols), 256)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import HASH_EXCLUDE

SEP = "\u001f"
NULL_MARK = "\u0001"


def encode(c: Column, dtype: T.DataType, scale: int = 6) -> Column:
    """Fixed text form of a value, null marked."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        v = c.cast("double") + F.lit(0.0)                  # +0.0 makes -0.0 the same as 0.0
        fixed = v.try_cast(T.DecimalType(38, scale))
        txt = F.when(fixed.cast("double") == v, fixed.cast("string")).otherwise(F.concat(F.lit("~"), v.cast("string")))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        txt = F.to_json(c)
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(NULL_MARK))


def encoded_concat(df: DataFrame, cols: Sequence[str], scale: int = 6) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws(SEP, *[encode(F.col(c), types[c], scale) for c in cols])


def hash_keys(df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (), scale: int = 6,
              key_col: str = "hkey", diff_col: str = "hdiff") -> DataFrame:
    """hkey = md5 of the business key, hdiff = md5 of every other column
    (system columns and ``exclude`` left out)."""
    skip = set(keys) | set(HASH_EXCLUDE) | set(exclude) | {key_col, diff_col}
    rest = [c for c in df.columns if c not in skip]
    return df.withColumns({
        key_col: F.md5(encoded_concat(df, keys, scale)),
        diff_col: F.md5(encoded_concat(df, rest, scale)),
    })


def row_sha2(df: DataFrame, cols: Sequence[str] | None = None, sep: str = "||", name: str = "row_hash") -> DataFrame:
    """sha2-256 of the separator-joined row, for tables without a key."""
    cols = list(cols or df.columns)
    return df.withColumn(name, F.sha2(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]), 256))
