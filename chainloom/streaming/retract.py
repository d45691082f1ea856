"""Aggregates over a chain with rollbacks: what a rollback undoes is subtracted, nothing else is counted anew.

Three kinds of parts are kept, each rewritten as a whole by the batches that touch it (``jobs.state``): the deltas of each
slot, by spans of slots; the first and last slot of each key in a span; and the merged counts and sums of each key, by
hash. A rollback reads and rewrites the spans beyond its slot, and the merged rows of the keys found there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom import folders
from chainloom.streaming import jobs


#: Rows up to which blocks of a batch, or keys that lose some, go to all tasks; beyond they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


@dataclass(frozen=True)
class Retracting:
    """A merged aggregate of rows (seq, kind, slot, keys, amount) in folder ``where``.

    ``keys`` is a schema of the keys; ``span`` slots are kept together, and merged rows in ``parts`` parts. A block is known
    by its slot: rows of a slot that stands already are left out, so that a restart may read some of them again.
    """

    where: str
    keys: str
    span: int
    parts: int = 16

    @property
    def names(self) -> list[str]:
        return [k.split()[0] for k in self.keys.split(",")]

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.names), F.lit(self.parts)).cast("int")

    def _span(self) -> Column:
        return F.floor(F.col("slot") / self.span).cast("int")

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").partitionBy("part__").parquet(f"{self.where}/{kind}/v{number}")

    def _latest(self, session, kind: str, below: int | None = None, only: set[int] | None = None) -> list[str]:
        found = jobs.state(session, f"{self.where}/{kind}", below)
        for paths in found.values():
            for path in paths[:-1] if below is not None else []:  # replaced by a complete version
                folders.remove(session, path)
        return [paths[-1] for part, paths in found.items() if only is None or int(part) in only]

    def step(self, batch: DataFrame, number: int) -> None:
        """Apply a batch: what it leaves behind follows from older versions and the batch alone."""
        session, names = batch.sparkSession, self.names
        batch = batch.persist()
        back = batch.where("kind = 'rollback'").agg(F.min("slot")).first()[0]
        # which blocks stand follows from the blocks alone, so that no window has to move their rows
        standing = jobs.standing(batch.select("seq", "kind", "slot").distinct()).select("seq", "slot").persist()
        fresh_spans = {r[0] for r in standing.select(self._span()).distinct().collect()}  # few: a batch is a range of slots
        stored = {int(p) for p in jobs.state(session, f"{self.where}/slots", number)}
        touched = fresh_spans | {s for s in stored if back is not None and (s + 1) * self.span > back + 1}
        held = jobs.read_parts(session, self._latest(session, "slots", number, touched), f"slot long, {self.keys}, n long, amount long").where("n > 0").persist()
        stays = F.lit(True) if back is None else F.col("slot") <= back
        kept, gone = held.where(stays), held.where(~stays)
        new = standing.join(kept.select("slot").distinct(), "slot", "left_anti").select(F.col("seq").alias("seq__"), F.col("slot").alias("slot__")).persist()
        rows = batch.where("kind = 'forward'").join(_small(new), (F.col("seq") == F.col("seq__")) & F.col("slot").eqNullSafe(F.col("slot__")), "left_semi")
        fresh = rows.groupBy("slot", *names).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")).persist()
        # a row without a count for each span, so that an emptied one has a newest version too
        marks = session.createDataFrame([(s * self.span,) for s in sorted(touched)], "slot long").select("slot", *(F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in self.keys.split(",")), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("amount"))
        self._write(kept.unionByName(fresh).unionByName(marks).withColumn("part__", self._span()), "slots", number)
        now = jobs.read_parts(session, [f"{self.where}/slots/v{number}"], f"slot long, {self.keys}, n long, amount long, part__ int")
        self._write(now.groupBy("part__", *names).agg(F.min("slot").alias("first"), F.max("slot").alias("last"), F.sum("n").alias("n")), "ends", number)
        parts = {r[0] for r in fresh.select(*names).unionByName(gone.select(*names)).select(self._part()).distinct().collect()}  # at most ``parts``
        old = jobs.read_parts(session, self._latest(session, "totals", number, parts), self._totals)
        self._latest(session, "ends", number)
        rows = fresh.select(*names, "n", "amount", F.col("slot").alias("first"), F.col("slot").alias("last"))
        lost = gone.select(*names).distinct().persist()
        if not lost.isEmpty():
            # keys that lost slots take their ends from those of the spans, which hold this batch already, not from their old ones
            few = _small(lost.select(*(F.col(k).alias(f"{k}__") for k in names), F.lit(True).alias("void")))
            same = [F.col(k).eqNullSafe(F.col(f"{k}__")) for k in names]
            zero = [F.lit(0).cast("long").alias(c) for c in ("n", "amount")]
            ends = jobs.read_parts(session, self._latest(session, "ends"), f"{self.keys}, first long, last long, n long").where("n > 0")
            old = old.join(few, same, "left").select(*names, "n", "amount", *(F.when(F.col("void").isNull(), F.col(c)).alias(c) for c in ("first", "last")))
            less = gone.select(*names, *((-F.col(c)).alias(c) for c in ("n", "amount")), *(F.lit(None).cast("long").alias(c) for c in ("first", "last")))
            rows = rows.unionByName(less).unionByName(ends.join(few, same, "left_semi").select(*names, *zero, "first", "last"))
        # dealt by part once, as they are stored; whole parts are rewritten, the rows of other keys as they are
        rows = old.unionByName(rows).withColumn("part__", self._part()).repartition("part__")
        self._write(rows.groupBy("part__", *names).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.min("first").alias("first"), F.max("last").alias("last")), "totals", number)
        for frame in (batch, standing, held, new, fresh, lost):
            frame.unpersist()

    @property
    def _totals(self) -> str:
        return f"{self.keys}, n long, amount long, first long, last long"

    def run(self, stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
        """Apply all that a stream has now, batch by batch, and return the aggregate."""
        jobs.run_batches(stream, checkpoint or f"{self.where}/checkpoint", self.step)
        return self.table(stream.sparkSession)

    def table(self, session) -> DataFrame:
        """keys, n, amount, first, last of the keys that have any rows."""
        return jobs.read_parts(session, self._latest(session, "totals"), self._totals).where("n > 0")
