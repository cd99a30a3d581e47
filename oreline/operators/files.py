"""The few file-system calls a table needs, on whatever store the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a directory, hidden ones left out; empty where there is none."""
    fs, target = _located(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in names if not n.startswith(".") and n != "_SUCCESS" and n != "_temporary")


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _located(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is below it; nothing where it is missing."""
    fs, target = _located(spark, path)
    fs.delete(target, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file in one step; False if it is already there.

    Whole or absent on every store whose rename is atomic and refuses an existing
    target, such as HDFS. On an object store two writers may pass the check.
    """
    folder, name = path.rsplit("/", 1)
    fs, target = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False
