"""Selection by long lists and many ranges: selectors are tables, joined by key or by bins of slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def keyed_matches(facts: DataFrame, selectors: DataFrame) -> DataFrame:
    """Transactions (tx_hash) of ``facts`` (tx_hash, kind, value) that a selector (kind, value) names, each once.

    Selectors may be as many as the facts: both are joined by kind and value, and selectors that repeat count once.
    """
    return facts.join(selectors.select("kind", "value").distinct(), ["kind", "value"], "left_semi").select("tx_hash").distinct()


def _merged(ranges: DataFrame, step: int) -> DataFrame:
    """bin and parts: of each bin of ``step`` slots the disjoint stretches that the ranges cover, step / 2 at most."""
    low, high = F.col("bin") * step, (F.col("bin") + 1) * step - 1
    bins = ranges.withColumn("bin", F.explode(F.sequence(F.floor(F.col("first") / step), F.floor(F.col("last") / step))))
    cut = bins.select("bin", F.greatest("first", low).alias("first"), F.least("last", high).alias("last")).distinct()
    before = Window.partitionBy("bin").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.when(F.col("first") <= F.max("last").over(before) + 1, 0).otherwise(1)
    numbered = cut.withColumn("apart", apart).withColumn("stretch", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = numbered.groupBy("bin", "stretch").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return stretches.groupBy("bin").agg(F.collect_list(F.struct("first", "last")).alias("parts"))


def in_ranges(rows: DataFrame, ranges: DataFrame, slot: str = "slot_no", width: int = 1 << 12, wide: int = 1 << 10) -> DataFrame:
    """Rows whose slot lies in any of ``ranges`` (first, last), ends included.

    Ranges are cut at multiples of ``width`` and merged within these bins; a row meets what is left in its own bin, so
    that a comparison is made for each stretch there and not for each range. A range over more than ``wide`` bins takes
    bins ``wide`` times as wide, so that a long one stays a few rows. Ranges that have a null or end before they begin
    select nothing; rows with a null slot are never selected, repeated rows each.
    """
    kept = ranges.where("first <= last").select("first", "last").distinct()
    spread = F.floor(F.col("last") / width) - F.floor(F.col("first") / width)
    inside, met = F.lit(False), rows
    for k, (step, some) in enumerate(((width, kept.where(spread < wide)), (width * wide, kept.where(spread >= wide)))):
        bins = _merged(some, step).select(F.col("bin").alias(f"bin{k}__"), F.col("parts").alias(f"parts{k}__"))
        met = met.join(bins, F.floor(F.col(slot) / step) == F.col(f"bin{k}__"), "left")
        inside = inside | F.coalesce(F.exists(f"parts{k}__", lambda p: (F.col(slot) >= p["first"]) & (F.col(slot) <= p["last"])), F.lit(False))
    return met.where(inside).select(*rows.columns)
