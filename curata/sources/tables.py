"""Catalog table readers with name checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualify_two_level(name: str, default_db: str = "default") -> str:
    if not isinstance(name, str):
        raise ValueError("table name must be a string")
    return name if "." in name else f"{default_db}.{name}"


def read_table(spark: SparkSession, name: str, options: dict | None = None) -> DataFrame:
    """Two-level name, default database filled in."""
    if options:
        raise NotImplementedError("reader options are not supported for catalog tables")
    return spark.read.table(qualify_two_level(name))


def read_three_level(spark: SparkSession, name: str, options: dict | None = None) -> DataFrame:
    """Three-level name: exactly two dots."""
    if options:
        raise NotImplementedError("reader options are not supported for catalog tables")
    if not isinstance(name, str) or name.count(".") != 2:
        raise ValueError("table name must be in the format 'catalog.schema.table'")
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
