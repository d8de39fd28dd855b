"""Questions about paths, asked through the session's own file system (HDFS, object store, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, sorted; empty when there are none."""
    fs, target = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or [])


def has_data(spark: SparkSession, pattern: str) -> bool:
    """Whether a file, folder or glob holds at least one non-empty file."""
    fs, target = _file_system(spark, pattern)
    for status in fs.globStatus(target) or []:
        if status.isFile():
            if status.getLen() > 0:
                return True
            continue
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            entry = files.next()
            if entry.getLen() > 0 and not entry.getPath().getName().startswith(("_", ".")):
                return True
    return False


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()
