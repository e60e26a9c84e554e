"""File-system helpers over the Hadoop FileSystem API.

They work on any Hadoop-compatible store (HDFS, object stores, local), so
the same code runs on a cluster and in tests.  Only metadata calls go
through the driver; data never does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs_and_path(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def mkdirs(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.mkdirs(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the immediate sub-folders of ``path`` (empty if absent)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path`` (empty if absent)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one visible data file below it."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def plain_path(spark: SparkSession, path: str) -> str:
    """The path part of ``path``, made absolute, without scheme or host."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toUri().getPath()
