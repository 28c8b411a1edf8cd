"""Folder operations on whatever file system a path names."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.mkdirs(target)


def folders_with(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the folders holding a file that matches a glob pattern."""
    fs, target = _path(spark, pattern)
    return [s.getPath().getParent().toString() for s in fs.globStatus(target) or []]


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)
