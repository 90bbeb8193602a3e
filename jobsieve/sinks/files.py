"""Small driver-side files in any store that Spark can reach."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


#: The beginning of a path of a store that has no host.
NO_HOST = r"^([^:/]+):/{3,}"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path).exists(_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store, encoded; without the slashes of an empty host, which Spark's names of files have or lack."""
    store = _store(spark, path)
    whole = _path(spark, path).makeQualified(store.getUri(), store.getWorkingDirectory()).toUri().toString()
    return re.sub(NO_HOST, r"\1:/", whole).rstrip("/")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file; None if there is none."""
    if not exists(spark, path):
        return None
    stream = _store(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """Writes a file piece by piece under another name, then moves it: readers see all of it or none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = _path(spark, path)
    target = target.makeQualified(_store(spark, path).getUri(), _store(spark, path).getWorkingDirectory())
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = _store(spark, path).create(part)
    try:
        for line in lines:
            stream.write(bytearray(line.encode("utf-8")))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, over)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_lines(spark, path, [text])
