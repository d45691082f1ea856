"""Shared folders for what must outlive a job: they lie where the session's ``spark.checkpoint.dir`` says."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def base(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only where none is set and all tasks run in this machine's one process, as in
    tests, a temporary one is made."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="chainloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return ("file://" + found if found.startswith("/") else found).rstrip("/")


def new(spark: SparkSession, name: str) -> str:
    """A folder of its own below it; nothing is created yet."""
    return f"{base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _path(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, where = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def stamps(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of all files of a table, in order."""
    system, where = _path(spark, path)
    found, files = [], system.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return sorted(found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a table."""
    system, where = _path(spark, path)
    return system.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    system, where = _path(spark, path)
    system.delete(where, True)
