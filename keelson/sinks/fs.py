"""Small driver-side file-system calls through the session's Hadoop
configuration (works for any file system the cluster is set up for).
Only names, sizes and empty marker files go through here, never rows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, recursive))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; its time is now if it exists already."""
    fs, p = _fs_and_path(spark, path)
    fs.create(p, True).close()


def entries(spark: SparkSession, folder: str) -> dict[str, float]:
    """Name and time of change (seconds) of what lies in a folder."""
    fs, p = _fs_and_path(spark, folder)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(p)}


def content(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(files, bytes) under a folder."""
    fs, p = _fs_and_path(spark, folder)
    summary = fs.getContentSummary(p)
    return summary.getFileCount(), summary.getLength()
