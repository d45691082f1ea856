"""Error logs: repeated errors as one, statistics, eviction of old ones, ordered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicated(log: DataFrame, keys: list[str], ts: str = "ts", details: str = "details") -> DataFrame:
    """One row for each signature: how often, first and last seen, and the last one's details."""
    latest = F.max(F.struct(ts, details))[details]
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), latest.alias("last_details"))


def statistics(errors: DataFrame, by: str) -> DataFrame:
    """Errors, distinct ones and the share of each kind."""
    kinds = errors.groupBy(by).agg(F.sum("count").alias("errors"), F.count(F.lit(1)).alias("distinct_errors"))
    whole = F.broadcast(kinds.agg(F.sum("errors").alias("all_errors")))
    return kinds.crossJoin(whole).withColumn("share", F.col("errors") / F.col("all_errors"))


def evict_oldest(errors: DataFrame, last_seen: str, key: str, percent: int = 10) -> DataFrame:
    """Without the oldest ``percent`` of the rows (one at least) by time last seen, ties in the order of the key.

    Rows are dealt to ranges of (time, key) and numbered within theirs; the sizes of the ranges, one row each, give the
    number of rows before a range.
    """
    dealt = errors.repartitionByRange(last_seen, key).sortWithinPartitions(last_seen, key)
    numbered = dealt.withColumn("part__", F.spark_partition_id()).withColumn("place__", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    sizes = numbered.groupBy("part__").agg(F.count(F.lit(1)).alias("n__"))
    before = F.coalesce(F.sum("n__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranges = F.broadcast(sizes.select("part__", before.alias("before__"), F.greatest(F.floor(whole * percent / 100), F.lit(1)).alias("evicted__")))
    kept = numbered.join(ranges, "part__").where(F.col("before__") + F.col("place__") >= F.col("evicted__"))
    return kept.select(*errors.columns)


def newer_than(errors: DataFrame, last_seen: str, interval: str) -> DataFrame:
    """Rows seen within an interval before the newest one."""
    newest = F.broadcast(errors.agg(F.max(last_seen).alias("newest__")))
    return errors.join(newest, F.col(last_seen) > F.col("newest__") - F.expr(f"INTERVAL {interval}")).drop("newest__")


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 0).when(severity == "ERROR", 1).when(severity == "WARNING", 2).otherwise(3)


def report(errors: DataFrame, severity: str, last_seen: str, key: str, most: int) -> DataFrame:
    """The first ``most`` errors, gravest and then newest first, numbered from 1."""
    order = [severity_rank(F.col(severity)), F.desc(last_seen), F.col(key)]
    return errors.orderBy(*order).limit(most).withColumn("number", F.row_number().over(Window.orderBy(*order)).cast("long"))


def gaps(events: DataFrame, ts: str, key: str, seconds: int) -> DataFrame:
    """Pauses longer than ``seconds`` between the events of a key, with where they begin and end.

    Events are put in order within a key's days, which also gives the edges of each day; a window over one row for each key
    and day joins them.
    """
    rows = events.where(F.col(ts).isNotNull()).select(key, ts, F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 86400).alias("day__"))
    day = Window.partitionBy(key, "day__").orderBy(ts)
    inside = rows.withColumns({"before": F.lag(ts).over(day), "last__": F.max(ts).over(day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    firsts = inside.where("before is null").select(key, ts, "day__", "last__")
    edges = firsts.withColumn("before", F.lag("last__").over(Window.partitionBy(key).orderBy("day__", ts)))
    rows = inside.select(key, ts, "before").unionByName(edges.select(key, ts, "before")).where("before is not null")
    pause = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
    return rows.select(key, F.col("before").alias("gap_start"), F.col(ts).alias("gap_end"), pause.alias("gap_us")).where(F.col("gap_us") > seconds * 1_000_000)
