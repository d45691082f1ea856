"""State of single keys that ends by itself: episodes of repeated errors, and retries that fall due.

Both are stateful processors with event-time timers. Rows of one key have to come in order of time but for what lies in
one batch, which is sorted; a stored table laid out by time does.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from chainloom.streaming import jobs

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = datetime.datetime(1970, 1, 1)


def _millis(at: pd.Timestamp | datetime.datetime) -> int:
    return (at - EPOCH) // datetime.timedelta(milliseconds=1)


def _up(at: datetime.datetime) -> int:
    """The first whole millisecond that is not before a time: timers know no finer ones."""
    return -((EPOCH - at) // datetime.timedelta(milliseconds=1))


class Episodes(StatefulProcessor):
    """Repeats of a signature whose gaps are ``quiet`` at most, merged; state goes when the watermark is beyond them."""

    def __init__(self, quiet: datetime.timedelta, ts: str):
        self.quiet, self.ts = quiet, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "count long, first timestamp, last timestamp")

    def _row(self, key: tuple, count: int, first: datetime.datetime, last: datetime.datetime) -> tuple:
        return (*key, count, first, last)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        times = pd.concat([r[self.ts] for r in rows]).sort_values()
        held = self.open.get()
        count, first, last = (int(held[0]), held[1], held[2]) if held is not None else (0, None, None)
        ended, before = [], last
        for at in times.dt.to_pydatetime() if hasattr(times, "dt") else times:
            if count and at - last > self.quiet:
                ended.append(self._row(key, count, first, last))
                count = 0
            count, first, last = count + 1, at if not count else first, at if not count else max(last, at)
        if before is not None:
            self.handle.deleteTimer(_up(before + self.quiet))
        self.open.update((count, first, last))
        self.handle.registerTimer(_up(last + self.quiet))
        if ended:
            yield self._frame(ended)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.open.get()
        if held is not None:
            self.open.clear()
            yield self._frame([self._row(key, int(held[0]), held[1], held[2])])

    def close(self) -> None:
        pass


class Retries(StatefulProcessor):
    """What has failed and has to be fetched again: each failure in a row waits longer, a success ends the row, and after
    ``most`` failures nothing more is tried. A retry falls due when the watermark is beyond its time.

    Keys have a few rows in a batch, so that these come as rows: a frame for each key costs more than its rows. Times
    (at__, due) are microseconds; timers take the first whole millisecond that is not before one."""

    def __init__(self, step: datetime.timedelta, most: int, failed: str, columns: list[str]):
        self.step, self.most, self.failed, self.row = step // datetime.timedelta(microseconds=1), most, failed, Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waits = handle.getValueState("waits", "failures int, due long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        some = sorted((r["at__"], r[self.failed]) for r in rows)
        held = self.waits.get()
        failures, due = (int(held[0]), held[1]) if held is not None else (0, None)
        before, known = due, held is not None
        for at, failed in some:
            if due is not None and due <= at:  # it fell due before this row came
                yield self.row(*key, failures, due)
            failures = failures + 1 if failed else 0
            due = at + self.step * failures if 0 < failures <= self.most else None
        if before is not None:
            self.handle.deleteTimer(-(-before // 1000))
        if failures:
            self.waits.update((failures, due))
        elif known:
            self.waits.clear()
        if due is not None:
            self.handle.registerTimer(-(-due // 1000))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self.waits.get()
        if held is not None and held[1] is not None:
            # how often it has failed stays known, until a success or the last failure clears it
            self.waits.update((int(held[0]), None))
            yield self.row(*key, int(held[0]), held[1])

    def close(self) -> None:
        pass


def _apply(events: DataFrame, keys: list[str], processor: StatefulProcessor, schema: StructType) -> DataFrame:
    processor.columns = [f.name for f in schema.fields]
    return events.groupBy(*keys).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def _schema(events: DataFrame, keys: list[str], more: str) -> StructType:
    return StructType([*(events.schema[k] for k in keys), *StructType.fromDDL(more).fields])


def episodes(events: DataFrame, keys: list[str], ts: str, quiet: datetime.timedelta, late: str) -> DataFrame:
    """keys, count, first and last of each episode that has ended."""
    rows = events.select(*keys, F.col(ts).alias(ts)).withWatermark(ts, late)
    return _apply(rows, keys, Episodes(quiet, ts), _schema(events, keys, "count long, first timestamp, last timestamp"))


def retries(events: DataFrame, keys: list[str], ts: str, failed: str, step: datetime.timedelta, most: int, late: str) -> DataFrame:
    """keys, failures and due of each retry that has fallen due."""
    rows = events.select(*keys, ts, failed, F.unix_micros(ts).alias("at__")).withWatermark(ts, late)
    schema = _schema(events, keys, "failures int, due long")
    due = rows.groupBy(*keys).transformWithState(statefulProcessor=Retries(step, most, failed, schema.fieldNames()), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return due.withColumn("due", F.timestamp_micros("due"))


def run(stream: DataFrame, where: str) -> DataFrame:
    """Run a stream with keyed state over all that is there now, and read what it has written."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, PROVIDER)  # keyed state with timers lives in RocksDB
    try:
        return jobs.run_open(stream, where)
    finally:
        conf.set(name, before)
