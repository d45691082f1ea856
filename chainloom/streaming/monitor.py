"""Progress of streams as rows, and actions at new epochs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from chainloom import folders

KEPT = 300


class ProgressLog(StreamingQueryListener):
    """The last progress reports of all streams: what a dashboard shows."""

    def __init__(self, kept: int = KEPT):
        self.rows: list[tuple] = []
        self.kept, self.errors = kept, 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.rows.append((p.name or str(p.id), p.batchId, p.timestamp, int(p.numInputRows), float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0)))
        del self.rows[: -self.kept]

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.errors += event.exception is not None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "stream string, batch long, at string, rows long, rows_in_per_second double, rows_done_per_second double")


class Observed(StreamingQueryListener):
    """Metrics that a stream observes under a name, one row for each batch that had any rows."""

    def __init__(self, name: str):
        self.name, self.rows = name, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and event.progress.numInputRows:
            self.rows[event.progress.batchId] = tuple(found)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def follow(self, spark: SparkSession, writer: DataStreamWriter, batches: int, patience: float = 30.0) -> None:
        """Run a stream of a session to its end. Reports come behind the batches: those of ``batches`` are waited for."""
        streams = spark.streams
        streams.addListener(self)
        try:
            writer.start().awaitTermination()
            until = time.monotonic() + patience
            while len(self.rows) < batches and time.monotonic() < until:
                time.sleep(0.05)
        finally:
            streams.removeListener(self)
        if len(self.rows) < batches:
            raise TimeoutError(f"{batches - len(self.rows)} of {batches} batches were not reported")

    def table(self, spark: SparkSession, schema: str) -> DataFrame:
        return spark.createDataFrame([self.rows[k] for k in sorted(self.rows)], schema)


def _in_order(epoch: str) -> tuple[int, str]:
    """Epochs' names in the order of epochs, be they numbers or days."""
    return len(epoch), epoch


class EpochJobs:
    """Runs an epoch's job once its blocks are complete: when a stream in the order of slots brings a block of a later one.

    Blocks are kept in folder ``where`` by epoch and batch, and ``job(blocks, epoch)`` gets those of one epoch; what it
    returns is written as that epoch's result. Which epochs have begun is read from the folder, so that a restart goes on
    where the last run stood, and a repeated batch or job writes the same again.
    """

    def __init__(self, where: str, schema: str, epoch: str, job: Callable[[DataFrame, object], DataFrame], result: str):
        self.where, self.schema, self.epoch, self.job, self.result = where, schema, epoch, job, result

    def _epochs(self, spark: SparkSession, folder: str) -> set[str]:
        return {n.partition("=")[2] for n in folders.names(spark, f"{self.where}/{folder}") if n.startswith("of=")}

    def _run(self, spark: SparkSession, epoch: str) -> None:
        blocks = spark.read.schema(self.schema).parquet(f"{self.where}/blocks/of={epoch}")
        self.job(blocks, epoch).write.mode("overwrite").parquet(f"{self.where}/results/of={epoch}")

    def step(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = [str(r[0]) for r in batch.select(self.epoch).distinct().collect()]  # epochs of one batch: very few
        for epoch in found:
            batch.where(F.col(self.epoch).cast("string") == epoch).write.mode("overwrite").parquet(f"{self.where}/blocks/of={epoch}/batch={number}")
        begun, done = self._epochs(spark, "blocks"), self._epochs(spark, "results")
        newest = max(begun, key=_in_order, default=None)
        # blocks that come late have their epoch's job run again
        for epoch in sorted((e for e in begun if e != newest and (e not in done or e in found)), key=_in_order):
            self._run(spark, epoch)

    def finish(self, spark: SparkSession) -> DataFrame:
        """The results of all epochs, the open one's too: its job runs again with the blocks that are there."""
        begun = self._epochs(spark, "blocks")
        if begun:
            self._run(spark, max(begun, key=_in_order))
        paths = [f"{self.where}/results/of={e}" for e in sorted(begun)]
        return spark.read.schema(self.result).parquet(*paths) if paths else spark.createDataFrame([], self.result)


def slots_behind(slot: Column, tip: Column) -> Column:
    return F.greatest(tip - slot, F.lit(0).cast("long"))


def is_near_tip(slot: Column, tip: Column, most_behind: int = 3600) -> Column:
    """``near_tip`` of columns."""
    return slots_behind(slot, tip) <= most_behind


def near_tip(slot: int, tip: int, most_behind: int = 3600) -> bool:
    """Whether live queries of the ledger's state make sense yet."""
    return max(0, tip - slot) <= most_behind
