"""The few file-system questions a store asks, for any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it is absent."""
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files directly under ``path``; none if it is absent."""
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    found = [s.getPath() for s in fs.listStatus(target) if s.isFile()]
    return sorted(f.toString() for f in found if not f.getName().startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, target = _handle(spark, path)
    return fs.getContentSummary(target).getLength()
