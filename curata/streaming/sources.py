"""File streams with lineage and control columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import with_lineage

STREAM_FORMATS = ("parquet", "csv", "json", "orc", "delta", "cloudFiles")

# Auto-loader options with a native file-stream equivalent;
# the other cloudFiles.* options belong to the notification service and the
# schema-rescue store, which a native file stream does not have.
CLOUDFILES_NATIVE = {
    "cloudFiles.maxFilesPerTrigger": "maxFilesPerTrigger",
    "cloudFiles.maxBytesPerTrigger": "maxBytesPerTrigger",
    "cloudFiles.pathGlobFilter": "pathGlobFilter",
}


def _native_options(fmt: str, opts: dict) -> tuple[str, dict]:
    """Map an auto-loader source (``cloudFiles``) onto the native file stream
    of its ``cloudFiles.format``."""
    if fmt != "cloudFiles":
        return fmt, opts
    if "cloudFiles.format" not in opts:
        raise ValueError("a cloudFiles source needs the cloudFiles.format option")
    native = {}
    for k, v in opts.items():
        if k in CLOUDFILES_NATIVE:
            native[CLOUDFILES_NATIVE[k]] = v
        elif not k.startswith("cloudFiles."):
            native[k] = v
    return opts["cloudFiles.format"], native


def stream(spark: SparkSession, fmt: str, path: str, options: dict | None = None, schema=None,
           lineage: bool = False, normalize: bool = True) -> DataFrame:
    """A file stream.  Without a schema it is taken from a zero-row batch
    read of the same path (a footer read for parquet and orc; JSON reads every
    file to infer one, so give it a schema); ``schema="newest"`` takes it from
    the most recently modified file instead (older files then read with
    nulls for columns they lack).  Options such as pathGlobFilter,
    recursiveFileLookup and maxFilesPerTrigger pass through."""
    if fmt not in STREAM_FORMATS:
        raise ValueError(f"unsupported stream source {fmt!r}; one of {STREAM_FORMATS}")
    opts = {k: str(v) for k, v in (options or {}).items()}
    fmt, opts = _native_options(fmt, opts)
    batch_opts = {k: v for k, v in opts.items() if k not in ("maxFilesPerTrigger", "maxBytesPerTrigger")}
    if isinstance(schema, str) and schema == "newest":
        from ..sources.files import read_latest_file
        schema = read_latest_file(spark, fmt, path, batch_opts).schema
    if schema is None:
        schema = spark.read.format(fmt).options(**batch_opts).load(path).limit(0).schema
    df = spark.readStream.format(fmt).options(**opts).schema(schema).load(path)
    if normalize:
        df = df.toDF(*[c.replace("/", "_") for c in df.columns])
    return with_lineage(df) if lineage else df


def with_stream_control(df: DataFrame, as_of) -> DataFrame:
    """is_current / is_deleted / start_time / end_time / row_creation_time."""
    from ..sources.files import with_scd_control
    return with_scd_control(df, as_of)


def file_name(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    return df.withColumn("file_name", decoded_name(F.col(path_col)))


def decoded_name(path):
    """Last path segment of a ``_metadata.file_path`` URI, decoded.  The URI
    encodes blanks as %20 but leaves '+' alone, while url_decode reads '+' as
    a blank -- so '+' is escaped first."""
    last = F.element_at(F.split(path, "/"), -1)
    return F.url_decode(F.regexp_replace(last, r"\+", "%2B"))
