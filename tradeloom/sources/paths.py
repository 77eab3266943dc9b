"""Folders on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    located, files = _located(spark, path)
    return files.exists(located)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    located, files = _located(spark, path)
    if not files.exists(located):
        return []
    return [s.getPath().toString() for s in files.listStatus(located) if s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    located, files = _located(spark, path)
    files.delete(located, True)
