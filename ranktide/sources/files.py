"""Files of the shared storage that are no tables: exclusive creation, listing and removal through Hadoop's file systems."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def create_new(spark: SparkSession, path: str, content: str = "") -> bool:
    """Creates a file that must not exist; False if it does.

    Of several writers one succeeds, as far as the file system's ``create`` without overwriting is exclusive.
    """
    system, where = _open(spark, path)
    try:
        out = system.create(where, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or system.exists(where):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system, sorted; none if there is nothing."""
    system, where = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(where) or [])


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    system, where = _open(spark, path)
    stream = system.open(where)
    try:
        size = system.getFileStatus(where).getLen()
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    """Removes a file, or a folder with all that is in it."""
    system, where = _open(spark, path)
    return system.delete(where, True)
