"""File readers (parquet, csv, json, orc, any format by name).

Lineage columns come from the hidden ``_metadata`` struct of file sources, so
they cost nothing extra at scan time and work on streams too.  The load time
(``as_of``) is an argument: a deterministic literal keeps re-runs and tests
reproducible; pass ``F.current_timestamp()`` for wall-clock stamping.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import as_of_col

LISTING = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")
FORMATS = ("parquet", "csv", "json", "orc", "text", "avro", "delta")


def _reader(spark: SparkSession, fmt: str, options: dict | None, schema=None):
    r = spark.read.format(fmt)
    if options:
        r = r.options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r


def with_lineage(df: DataFrame) -> DataFrame:
    """file_modification_time and file_path from the scan metadata."""
    return df.withColumns({
        "file_modification_time": F.col("_metadata.file_modification_time"),
        "file_path": F.col("_metadata.file_path"),
    })


def with_scd_control(df: DataFrame, as_of) -> DataFrame:
    """Control columns of a row entering an SCD table."""
    t = as_of_col(as_of)
    return df.withColumns({
        "is_current": F.lit(1),
        "is_deleted": F.lit(0),
        "start_time": t,
        "end_time": F.lit(None).cast("timestamp_ntz"),
        "row_creation_time": t,
    })


def read_parquet(spark: SparkSession, path: str, options: dict | None = None,
                 as_of="2002-01-01 00:00:00", order_by_file_time: bool = False) -> DataFrame:
    """Parquet read with lineage.

    With reader options: lineage + SCD control columns (is_current, is_deleted,
    start_time, end_time, row_creation_time).  Without: lineage,
    read_creation_time and is_deleted=0.  A global order by file time is only
    applied when asked for -- the next shuffle would discard it anyway.
    """
    df = with_lineage(_reader(spark, "parquet", options).load(path))
    if options is not None:
        df = with_scd_control(df, as_of)
    else:
        df = df.withColumns({"read_creation_time": as_of_col(as_of), "is_deleted": F.lit(0)})
    if order_by_file_time:
        df = df.orderBy("file_modification_time")
    return df


def read_csv(spark, path, options=None, schema=None) -> DataFrame:
    return _reader(spark, "csv", options, schema).load(path)


def read_json(spark, path, options=None, schema=None) -> DataFrame:
    return _reader(spark, "json", options, schema).load(path)


def read_orc(spark, path, options=None, schema=None) -> DataFrame:
    return _reader(spark, "orc", options, schema).load(path)


def read_format_path(spark, path, options=None, fmt: str = "parquet", schema=None) -> DataFrame:
    """Path read for any installed format (a Delta path needs its connector;
    the format is a parameter so the same call serves parquet folders)."""
    return _reader(spark, fmt, options, schema).load(path)


def read(spark: SparkSession, fmt: str, path: str, options: dict | None = None,
         lineage: bool = False, schema=None) -> DataFrame:
    """Generic reader; lineage columns on request."""
    df = _reader(spark, fmt, options, schema).load(path)
    return with_lineage(df) if lineage else df


def latest_file(spark: SparkSession, fmt: str, path: str, options: dict | None = None) -> DataFrame:
    """One row (file_path, file_modification_time) for the newest file.

    The files are listed as binary files, one row each; their content column is
    pruned, so no file of any format is opened.  ``max_by`` has map-side
    partials, so no window over all files is needed.
    """
    listing = {k: v for k, v in (options or {}).items() if k in LISTING}
    meta = (_reader(spark, "binaryFile", listing).load(path)
            .select(F.col("path").alias("p"), F.col("modificationTime").alias("t")))
    return meta.agg(F.max_by("p", F.struct("t", "p")).alias("file_path"),
                    F.max("t").alias("file_modification_time"))


def read_latest_file(spark: SparkSession, fmt: str, path: str, options: dict | None = None) -> DataFrame:
    """Read only the newest file of a folder (its schema defines the load).

    The newest path is a single control value (one row), so fetching it to
    the driver is bounded regardless of data size.
    """
    newest = latest_file(spark, fmt, path, options).first()
    if newest is None or newest["file_path"] is None:
        return _reader(spark, fmt, options).load(path).limit(0)
    return _reader(spark, fmt, options).load(newest["file_path"])


def schema_of(spark: SparkSession, fmt: str, path: str, options: dict | None = None):
    """Schema from a zero-row batch read: from one file's footer for parquet and
    orc.  JSON, and CSV with inferSchema, read every file to infer one: give
    those readers a schema instead."""
    return _reader(spark, fmt, options).load(path).limit(0).schema


def initial_or_delta_path(control_row, initial_col="initial_filepath", delta_col="delta_filepath",
                          flag_col="is_initial_completed") -> str:
    """Read the initial folder until the initial load is marked complete."""
    flag = control_row[flag_col]
    done = flag is True or str(flag).strip().lower() in ("true", "1", "y", "yes")
    return control_row[delta_col] if done else control_row[initial_col]


READERS: dict[str, Callable] = {
    "parquet": read_parquet,
    "csv": read_csv,
    "json": read_json,
    "orc": read_orc,
}


def is_empty(df: DataFrame) -> bool:
    """Early exit test: one-row probe, not a count."""
    return df.isEmpty()
