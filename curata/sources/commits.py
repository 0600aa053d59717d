"""Small JSON records that commit a state: written under another name, then renamed,
so a reader sees the old record or the new one.  Works on any file system Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, name: str):
    """(file system, path) of a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    fs, path = hadoop_path(spark, folder)
    return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the records in a folder, rising."""
    return sorted(int(n[:-5]) for n in names(spark, folder) if n.endswith(".json"))


def read(spark: SparkSession, folder: str, number: int) -> dict:
    return json.loads(spark.read.option("wholetext", "true").text(f"{folder}/{number}.json").first()[0])


def write(spark: SparkSession, folder: str, number: int, record: dict, replace: bool = True) -> None:
    """Commit a record.  Without ``replace`` a number that is taken is refused, so of
    two loads that started from the same state only one commits."""
    fs, target = hadoop_path(spark, f"{folder}/{number}.json")
    _, draft = hadoop_path(spark, f"{folder}/{number}.draft")
    if fs.exists(target):
        if not replace:
            raise FileExistsError(f"{target} is committed already")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(record), "utf-8"))
    out.close()
    if replace:
        fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot commit {target}")


def remove(spark: SparkSession, name: str, recursive: bool = False) -> None:
    fs, path = hadoop_path(spark, name)
    fs.delete(path, recursive)
