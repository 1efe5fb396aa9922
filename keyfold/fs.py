"""Tiny Hadoop FileSystem helpers (driver side, metadata only).

They go through the JVM's Hadoop client so the same code works for local
paths, HDFS and object stores; no data passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the child directories of ``path`` ([] if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file atomically (write aside, then rename)."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(tmp, p)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the file, or of the files directly under the folder."""
    fs, p = _fs(spark, path)
    return ";".join(sorted(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}" for st in fs.listStatus(p)))
