"""Shared folders for intermediate tables and files.

Everything an operator keeps between jobs lies under the folder that the session names in
``spark.checkpoint.dir``: driver and executors can all see it, and what a finished task has written there
survives the loss of its executor.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from chainloom import folders

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their tasks can import it.

    To be called before functions for tasks are made; operators do so first of all.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "chainloom_ship.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder URI below the session's checkpoint folder."""
    ship(spark)
    return folders.new(spark, name)


#: Rows of a few numbers each that a task writes, where their number is known.
SMALL_ROWS = 100_000


def tasks_for(rows: int) -> int:
    return rows // SMALL_ROWS + 1


_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside pass ``rows`` rows at most between Spark and a task's Python at once: a batch lies in buffers
    that are doubled until it fits, on both sides."""
    before = spark.conf.get(_BATCHES)
    spark.conf.set(_BATCHES, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCHES, before)


def keep(df: DataFrame, name: str, compression: str = "zstd", most: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in a new shared folder and read it again: this cuts its lineage.

    ``most`` is a bound on its rows, if one is known and they are small: no more tasks and files are made than they fill.
    ``group_rows`` is a bound on the rows of a row group, for wide rows: tasks that write or read hold one group at a time.
    """
    spark = df.sparkSession
    if most is not None and tasks_for(most) < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(tasks_for(most))
    path = folder(spark, name)
    writer = df.write.option("compression", compression)
    if group_rows is not None:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    folders.remove(spark, path)


def input_partitions(df: DataFrame) -> int:
    """How many tasks a scan of ``df`` has now."""
    return df.rdd.getNumPartitions()
