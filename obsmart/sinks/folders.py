"""Partition folders of a path layer: which there are, and their removal.

Spark's dynamic overwrite replaces the partitions that have rows and leaves those that no longer
have any. Their folders are removed here, after the write has been committed: all of them are first
moved into one hidden folder (readers skip names that begin with ``_``), then deleted. A call that
is cut off can be repeated. Only folder names reach the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value -> path of the ``column=value`` folders right under ``path``."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return {n[len(column) + 1:]: f"{path.rstrip('/')}/{n}" for n in names if n.startswith(f"{column}=")}


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether there is nothing at ``path``."""
    fs, target = _at(spark, path)
    return not fs.exists(target) or not fs.listStatus(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` with all it holds."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def drop_folders(spark: SparkSession, root: str, names) -> list[str]:
    """Remove the folders ``names`` (relative to ``root``); returns those that were there."""
    fs, _ = _at(spark, root)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = root.rstrip("/")
    there = [n for n in names if fs.exists(hadoop_path(f"{root}/{n}"))]
    if there:
        bin_ = f"{root}/_dropped-{uuid.uuid4().hex}"
        fs.mkdirs(hadoop_path(bin_))
        for i, name in enumerate(there):
            fs.rename(hadoop_path(f"{root}/{name}"), hadoop_path(f"{bin_}/{i}"))
        remove(spark, bin_)
    return there


def drop_partitions(spark: SparkSession, path: str, column: str, values) -> list[str]:
    """Remove the partitions ``column=value`` of a path layer; returns the names that were there."""
    return drop_folders(spark, path, [f"{column}={v}" for v in values])
