"""Tiny Hadoop FileSystem helpers (work for local, HDFS and object stores)."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def signature(spark: SparkSession, path: str) -> str:
    """``<length>-<mtime>`` of a file or directory (changes when it is rewritten)."""
    fs, p = _fs_and_path(spark, path)
    st = fs.getFileStatus(p)
    length = fs.getContentSummary(p).getLength() if st.isDirectory() else st.getLen()
    return f"{length}-{st.getModificationTime()}"


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory ([] if there is none)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small driver-side file (overwrites): markers."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that ``write_text`` wrote."""
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or directory that this run made."""
    fs, p = _fs_and_path(spark, path)
    fs.delete(p, True)


def older_than(spark: SparkSession, path: str, hours: float, files: bool = False) -> list[str]:
    """Directories (or files) directly under ``path`` that were last changed that long ago."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    limit = int(time.time() * 1000 - hours * 3_600_000)
    return [str(s.getPath()) for s in fs.listStatus(p)
            if s.isDirectory() != files and s.getModificationTime() < limit]
