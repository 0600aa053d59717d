"""JDBC tables (control, rule and audit tables usually live in a database).

Reads can push an aggregate down as a derived table; writes append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Table or ``(select ...) q`` sub-query read; a partition column splits
    large reads into parallel range queries."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or 8, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_jdbc_query(spark: SparkSession, url: str, sql: str, properties: dict | None = None) -> DataFrame:
    """Aggregate pushed to the database as a derived table."""
    return read_jdbc(spark, url, f"({sql}) q", properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append") -> None:
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))
