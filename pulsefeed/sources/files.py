"""The few file-system questions a DataFrame reader cannot answer, for any Hadoop path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str, directories: bool | None = None) -> list[str]:
    """Sorted names directly under ``path``: all, only directories, or only files."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    found = fs.listStatus(target)
    return sorted(s.getPath().getName() for s in found if directories is None or s.isDirectory() == directories)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` directories directly under ``path``, sorted."""
    return sorted(n.split("=", 1)[1] for n in names(spark, path, True) if n.startswith(f"{column}="))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; of several writers exactly one gets True."""
    fs, target = _resolve(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
