"""Small files and folders beside the data, through the file system of the path itself."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written aside, then renamed over the old one in one step."""
    p, fs = file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(p), options)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    p, fs = file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*`` and ``{a,b}``."""
    p, fs = file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(p) or []]
