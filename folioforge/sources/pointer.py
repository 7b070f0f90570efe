"""Small pointer files on any Hadoop path, replaced by an atomic rename.

A reader sees the old or the new value. ``read_pointer`` returns None only for
a path that does not exist; every other trouble is raised, so that a failed
read is never taken for "nothing stored yet".
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_context(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    hpath = fs.makeQualified(hpath)
    return jvm, fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    _, fs, hpath = _file_context(spark, path)
    return bool(fs.exists(hpath))


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """The pointer's value, None if there is no such file."""
    jvm, fs, hpath = _file_context(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        value = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    value = value.strip()
    if not value:
        raise ValueError(f"empty pointer file: {path}")
    return value


def write_pointer(spark: SparkSession, path: str, value: str) -> None:
    """Write ``value`` beside ``path``, then rename it over ``path``."""
    jvm, fs, hpath = _file_context(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{hpath.toString()}.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        jvm.org.apache.commons.io.IOUtils.write(value + "\n", stream, "UTF-8")
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(aside, hpath, how)
