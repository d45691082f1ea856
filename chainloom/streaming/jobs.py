"""Structured Streaming: replays of stored events with windows, deduplication, merged state and rollbacks.

Sinks are idempotent: what a batch writes depends on its number and contents only, so that a batch repeated after a
failure leaves the same table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainloom import folders

#: Slots that a restart goes back behind the last stored block, for rollbacks.
SAFETY_SLOTS = 20


def replay(spark: SparkSession, path: str, files: int = 1, schema: str | None = None, base: str | None = None) -> DataFrame:
    """A stream of a table's files, some in each batch. A table that is one file is read from its folder by name.

    With ``schema`` the path may be a pattern; ``base`` is then the folder whose partition columns are read too.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    if schema:
        return reader.option("basePath", base or path).parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run(stream: DataFrame, where: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now, and read what it has written."""
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{where}/out").option("checkpointLocation", f"{where}/state").trigger(availableNow=True)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


def run_open(stream: DataFrame, where: str) -> DataFrame:
    """``run`` for sources that are not asked for all at once: batch by batch until nothing is left."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{where}/out")


def run_batches(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Give all that a stream has now to ``step``, batch by batch."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def state(spark: SparkSession, where: str, below: int | None = None) -> dict[str, list[str]]:
    """Folders of each part of the state, newest last, out of versions that are complete and older than ``below``.

    Only the newest version may be incomplete, by a failure: where others are, the committer does not mark what it has
    finished, and the state could not be told from what failures left.
    """
    found: dict[str, list[str]] = {}
    versions = sorted(int(v[1:]) for v in folders.names(spark, where) if re.fullmatch(r"v\d+", v))
    for v in (v for v in versions if below is None or v < below):
        inside = folders.names(spark, f"{where}/v{v}")
        if "_SUCCESS" not in inside and v != versions[-1]:
            raise ValueError(f"version {v} in {where} has no _SUCCESS: set mapreduce.fileoutputcommitter.marksuccessfuljobs")
        for part in inside if "_SUCCESS" in inside else []:
            if part.startswith("part__="):
                found.setdefault(part.partition("=")[2], []).append(f"{where}/v{v}/{part}")
    return found


def read_parts(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batches(stream: DataFrame, where: str, aggregate: Callable[[DataFrame], DataFrame], combine: Callable[[DataFrame], DataFrame], schema: str, part: Column) -> DataFrame:
    """Keep a table up to date batch by batch, and return it as it stands on disk.

    ``aggregate(batch)`` gives rows of the table's schema and ``combine(rows)`` merges rows with one key. ``part``, a
    small integer made of the key, cuts the table: a batch rewrites the parts that it touches only. Version n of a part
    follows from its older versions and batch n alone, so that a repeated batch writes the same again; what a complete
    version has replaced is removed by the batch after it. A restart without new batches finds the last versions.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        held = state(session, where, number)
        for paths in held.values():
            for path in paths[:-1]:
                folders.remove(session, path)
        fresh = aggregate(batch).withColumn("part__", part).persist()
        touched = [str(r[0]) for r in fresh.select("part__").distinct().collect()]  # bounded by the number of parts
        old = read_parts(session, [held[p][-1] for p in touched if p in held], schema).withColumn("part__", part)
        merged = combine(old.unionByName(fresh).drop("part__")).withColumn("part__", part)
        merged.repartition("part__").write.mode("overwrite").partitionBy("part__").parquet(f"{where}/v{number}")
        fresh.unpersist()

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return read_parts(spark, [paths[-1] for paths in state(spark, where).values()], schema)


def resume_slot(blocks: DataFrame, margin: int = SAFETY_SLOTS) -> DataFrame:
    """One row: the slot from which a restart reads again, 0 where nothing is stored."""
    last = F.coalesce(F.max("slot_no"), F.lit(0))
    return blocks.agg(F.greatest(last - margin, F.lit(0)).cast("long").alias("slot_no"))


def rate_windows(events: DataFrame, ts: str, width: str, late: str) -> DataFrame:
    """Events in tumbling windows; a window is final once the watermark has passed it."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("start"), "events")


def sessions(events: DataFrame, keys: list[str], ts: str, quiet: str, late: str) -> DataFrame:
    """keys, first, until and events of spans of time in which no gap of a key is as long as ``quiet``, which is what
    follows the last event. A span is final once the watermark has passed its end."""
    spans = events.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, quiet).alias("w"))
    return spans.agg(F.count(F.lit(1)).alias("events")).select(*keys, F.col("w.start").alias("first"), F.col("w.end").alias("until"), "events")


def open_sessions(spark: SparkSession, where: str, keys: list[str]) -> DataFrame:
    """The spans of ``sessions`` that a run has left in its state, since the watermark has not passed them."""
    if not folders.names(spark, f"{where}/state/commits"):  # no batch, no state
        return spark.createDataFrame([], "first timestamp, until timestamp, events long").select(*(F.lit(None).alias(k) for k in keys), "first", "until", "events")
    held = spark.read.format("statestore").load(f"{where}/state")
    return held.select(*(f"value.{k}" for k in keys), F.col("value.session_window.start").alias("first"), F.col("value.session_window.end").alias("until"), F.col("value.count").alias("events"))


def once(events: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """Each key's first event within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


#: Events of a log that are put in order together.
LOG_SPAN = 1 << 16


def standing(events: DataFrame) -> DataFrame:
    """The forward rows of a log (seq, kind, slot, ...) that no later rollback to a slot before theirs undoes.

    The smallest slot of the later rollbacks is taken within spans of the log by a window, and over all later spans by a
    window over one row for each span.
    """
    rows = events.withColumn("span__", F.floor(F.col("seq") / LOG_SPAN))
    back = F.when(F.col("kind") == "rollback", F.col("slot"))
    inside = Window.partitionBy("span__").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = Window.orderBy(F.desc("span__")).rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("span__").agg(F.min(back).alias("own")).select("span__", F.min("own").over(beyond).alias("beyond__"))
    marked = rows.withColumn("inside__", F.min(back).over(inside)).join(spans, "span__").withColumn("least__", F.least("inside__", "beyond__"))
    return marked.where("kind = 'forward' and (least__ is null or slot <= least__)").select(*events.columns)


def resolve_rollbacks(events: DataFrame) -> DataFrame:
    """Blocks that stand after a log of events (seq, kind, slot, hash): forward adds one, rollback drops those beyond."""
    return standing(events).groupBy(F.col("slot").alias("slot_no"), "hash").agg(F.max("seq").alias("seq"))
