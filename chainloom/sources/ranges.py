"""A stream source whose offsets are slots: stored Parquet tables read by ranges of an ordered integer column.

``spark.dataSource.register(SlotSource)`` once, then ``spark.readStream.format("slots")``. A batch holds whole row groups
until it has ``rows`` rows, so that it is bounded whatever is stored behind; each row group of it is read by a task of its
own. The store has to be laid out by the column (``lay_out``), else row groups overlap and are read for several batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chainloom import folders

#: Rows after which a batch is full, and rows of a row group.
BATCH_ROWS, GROUP_ROWS = 4096, 512


@dataclass(frozen=True)
class RowGroup(InputPartition):
    """Rows of one row group of a file with ``low`` <= column < ``high``."""

    path: str
    group: int
    low: int
    high: int


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _group_ranges(footer, column: str) -> list[tuple[int, int, int, int]]:
    """(low, high, rows, number) of a file's row groups."""
    out = []
    for k in range(footer.num_row_groups):
        group = footer.row_group(k)
        chunk = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column)
        if group.num_rows:
            out.append((chunk.statistics.min, chunk.statistics.max + 1, group.num_rows, k))
    return out


class SlotReader(DataSourceStreamReader):
    """``at`` is the slot behind the last batch that was planned; what is stored meanwhile is seen by the next batch."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path, self.column = schema, options["path"], options.get("column", "slot")
        self.first, self.rows = int(options.get("start", "0")), int(options.get("rows", str(BATCH_ROWS)))
        self.stop_before = int(options["before"]) if "before" in options else None
        self.at = max(self.first, int(options.get("reached", "0")))
        self._groups: dict[str, list[tuple[int, int, int, int]]] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {"slot": self.first}

    def groups(self) -> list[tuple[int, int, int, str, int]]:
        """(low, high, rows, file, number) of all row groups, by footers; each file's is read once."""
        system, folder = _folder(self.path)
        found = ds.dataset(folder, filesystem=system, format="parquet")
        for part in found.get_fragments():
            if part.path not in self._groups:
                self._groups[part.path] = _group_ranges(part.metadata, self.column)
        return sorted((low, high, n, path, k) for path, some in self._groups.items() for low, high, n, k in some)

    def latestOffset(self) -> dict:  # noqa: N802
        rows, end = 0, self.at
        for low, high, n, _, _ in self.groups():
            if high <= self.at:
                continue
            if rows >= self.rows and low >= end:
                break
            rows, end = rows + n, max(end, high)
        self.at = end if self.stop_before is None else max(self.at, min(end, self.stop_before))
        return {"slot": self.at}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        low, high = start["slot"], end["slot"]
        self.at = max(self.at, high)
        return [RowGroup(path, k, max(a, low), min(b, high)) for a, b, _, path, k in self.groups() if a < high and b > low]

    def read(self, partition: RowGroup) -> Iterator:
        system, _ = _folder(self.path)
        arrow = to_arrow_schema(self.schema)
        fragment = ds.ParquetFileFormat().make_fragment(partition.path, system, row_groups=[partition.group])
        within = (ds.field(self.column) >= partition.low) & (ds.field(self.column) < partition.high)
        for batch in fragment.scanner(schema=arrow, filter=within, batch_size=256).to_batches():
            yield batch

    def commit(self, end: dict) -> None:
        pass


class SlotSource(DataSource):
    """Options: path; column (slot); start, the first slot; before, the slot to stop at; rows of a batch; reached, where a
    restarted stream's own checkpoint stands (``reached``). The schema has to be given."""

    @classmethod
    def name(cls) -> str:
        return "slots"

    def schema(self) -> str:
        raise ValueError("give the stream's schema, with the columns that are wanted")

    def streamReader(self, schema: StructType) -> SlotReader:  # noqa: N802
        return SlotReader(schema, dict(self.options))


def lay_out(rows: DataFrame, path: str, column: str = "slot", group_rows: int = GROUP_ROWS, finish: Callable[[DataFrame], DataFrame] | None = None, parts: int | None = None) -> None:
    """Store a table for the source: files hold ranges of the column, row groups too.

    ``finish`` makes of narrow rows, which alone are shuffled, those to be stored, in their order; ``parts`` is the
    number of ranges, if not the session's."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, column).sortWithinPartitions(column)
    ranged = finish(ranged) if finish else ranged
    ranged.write.option("parquet.block.row.count.limit", group_rows).option("compression", "zstd").parquet(path)


def reached(spark: SparkSession, checkpoint: str) -> int:
    """The slot behind the last batch that a stream's checkpoint has planned, 0 if there is none."""
    numbers = [int(n) for n in folders.names(spark, f"{checkpoint}/offsets") if n.isdigit()]
    if not numbers:
        return 0
    lines = spark.read.text(f"{checkpoint}/offsets/{max(numbers)}").select(F.get_json_object("value", "$.slot").cast("long").alias("slot"))
    return lines.agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0]


def replay(spark: SparkSession, path: str, schema: str | StructType, column: str = "slot", rows: int = BATCH_ROWS, start: int = 0, before: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """A stream over a stored table from slot ``start`` on, ``rows`` rows or a little more in each batch."""
    spark.dataSource.register(SlotSource)
    reader = spark.readStream.format("slots").schema(schema).option("path", path).option("column", column).option("rows", rows).option("start", start)
    if before is not None:
        reader = reader.option("before", before)
    if checkpoint is not None:
        reader = reader.option("reached", reached(spark, checkpoint))
    return reader.load()
