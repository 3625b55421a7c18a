"""Names, sizes and removal of files, through the file system Spark itself uses for the path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


#: Files that a writer leaves beside the data.
MARKS = ("_SUCCESS", "_metadata", "_common_metadata")


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none when it is missing. One listing, nothing is opened."""
    fs, where = _at(spark, path)
    try:
        return [s.getPath().getName() for s in fs.listStatus(where)]
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception.getClass()):
            return []
        raise


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Data files under a folder and their bytes, summed up by the file system: one call, however many files. Only the
    folder itself holds marks that are no data."""
    fs, where = _at(spark, path)
    whole = fs.getContentSummary(where)
    files, total = whole.getFileCount(), whole.getLength()
    for name in MARKS:
        mark = spark._jvm.org.apache.hadoop.fs.Path(where, name)
        if fs.exists(mark):
            files, total = files - 1, total - fs.getFileStatus(mark).getLen()
    return files, total


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
