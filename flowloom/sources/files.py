"""Existence checks through the Hadoop file system, so they work on any storage Spark reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listing(spark: SparkSession, folder: str) -> set[str]:
    """Names in a folder; none if the folder is absent."""
    path = _path(spark, folder)
    fs = _fs(spark, path)
    if not fs.exists(path):
        return set()
    return {status.getPath().getName() for status in fs.listStatus(path)}


def exists(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return _fs(spark, target).exists(target)


def existing(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """Those of the paths that exist; each folder is listed once."""
    folders: dict[str, list[str]] = {}
    for path in paths:
        folders.setdefault(path.rsplit("/", 1)[0], []).append(path)
    found = set()
    for folder, wanted in folders.items():
        names = listing(spark, folder)
        found.update(p for p in wanted if p.rsplit("/", 1)[1] in names)
    return found


def modified(spark: SparkSession, path: str) -> int:
    """Modification time in epoch milliseconds."""
    target = _path(spark, path)
    return _fs(spark, target).getFileStatus(target).getModificationTime()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds, if it exists."""
    target = _path(spark, folder)
    _fs(spark, target).delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another path, if it exists."""
    old, new = _path(spark, source), _path(spark, target)
    fs = _fs(spark, old)
    if fs.exists(old):
        fs.mkdirs(new.getParent())
        fs.rename(old, new)
