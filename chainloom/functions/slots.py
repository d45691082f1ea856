"""Slots, epochs, times and eras of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the ledger: starts in Unix seconds, lengths, and the first slot of each era.
BYRON_START, SHELLEY_START = 1506203091, 1596059091
SHELLEY_SLOT, SHELLEY_EPOCH = 4492800, 208
BYRON_EPOCH_SLOTS, EPOCH_SLOTS, BYRON_SLOT_SECONDS = 21600, 432000, 20
ERA_SLOTS = (("Byron", 0), ("Shelley", 4492800), ("Allegra", 16588738), ("Mary", 23068794), ("Alonzo", 39916797), ("Babbage", 72316797), ("Conway", 133660800))
ERA_EPOCHS = (("byron", 0), ("shelley", 208), ("allegra", 236), ("mary", 251), ("alonzo", 290), ("babbage", 365), ("conway", 491))
ERA_BLOCK_TYPES = ("Byron", "Byron", "Shelley", "Allegra", "Mary", "Alonzo", "Babbage", "Conway")
PROTOCOLS = (("Byron", 1, 0), ("Shelley", 2, 0), ("Allegra", 3, 0), ("Mary", 4, 0), ("Alonzo", 6, 0), ("Babbage", 8, 0), ("Conway", 9, 0))
# First epoch of each tuning bucket with its workers and batch sizes.
TUNING = (
    (0, "Byron", 16, 1000, 2000, 2000, 1000, 200, 5000, 100000),
    (208, "Shelley", 12, 500, 1000, 1000, 500, 100, 2000, 50000),
    (236, "Allegra/Mary", 10, 400, 800, 800, 300, 80, 1500, 30000),
    (290, "Alonzo", 8, 300, 500, 500, 200, 50, 1000, 20000),
    (365, "Babbage", 6, 200, 300, 300, 100, 30, 500, 10000),
)


def _quotient(x: Column, by: int) -> Column:
    return F.floor(x / by).cast("long")


def epoch_of_slot(slot: Column) -> Column:
    """Epochs of 21,600 slots before Shelley, of 432,000 from its first slot on."""
    return F.when(slot < SHELLEY_SLOT, _quotient(slot, BYRON_EPOCH_SLOTS)).otherwise(SHELLEY_EPOCH + _quotient(slot - SHELLEY_SLOT, EPOCH_SLOTS))


def unix_time_of_slot(slot: Column) -> Column:
    return F.when(slot < SHELLEY_SLOT, BYRON_START + slot * BYRON_SLOT_SECONDS).otherwise(SHELLEY_START + slot - SHELLEY_SLOT).cast("long")


def time_of_slot(slot: Column) -> Column:
    return F.timestamp_seconds(unix_time_of_slot(slot))


def _step(x: Column, steps) -> Column:
    """The name of the last step that x has reached."""
    out = F.lit(steps[0][0])
    for name, start in steps[1:]:
        out = F.when(x >= start, F.lit(name)).otherwise(out)
    return out


def era_of_slot(slot: Column) -> Column:
    return _step(slot, ERA_SLOTS)


def era_of_epoch(epoch: Column) -> Column:
    return _step(epoch, ERA_EPOCHS)


def era_of_block_type(block_type: Column) -> Column:
    names = F.array(*map(F.lit, ERA_BLOCK_TYPES))
    return F.when(block_type.between(0, 7), F.element_at(names, block_type.cast("int") + 1)).otherwise("Unknown")


def tuning_bucket(epoch: Column) -> Column:
    return _step(epoch, [(t[1], t[0]) for t in TUNING])


def estimated_tip(now: Column) -> Column:
    """The slot that the chain has reached at a Unix time; never before Shelley's first."""
    return SHELLEY_SLOT + F.greatest(F.lit(0).cast("long"), now.cast("long") - SHELLEY_START)


def era_progress(slot: Column) -> list[Column]:
    """Percent of each era that lies behind a slot: 0 before it, 100 after it; the last counts 5 once it has begun."""
    out = []
    for k, (name, start) in enumerate(ERA_SLOTS):
        if k + 1 == len(ERA_SLOTS):
            part = F.when(slot >= start, 5.0).otherwise(0.0)
        else:
            end = ERA_SLOTS[k + 1][1]
            part = F.least(F.greatest((slot.cast("double") - start) / (end - start) * 100, F.lit(0.0)), F.lit(100.0))
        out.append(part.alias(name.lower()))
    return out


def sync_percent(slot: Column, tip: Column) -> Column:
    return F.when(tip > 0, F.least(slot * 100.0 / tip, F.lit(100.0))).otherwise(0.0)


def slots_behind(slot: Column, tip: Column) -> Column:
    return F.greatest(tip - slot, F.lit(0).cast("long"))


def backoff_ms(attempt: Column, base: int = 100, cap: int = 5000) -> Column:
    """Doubling pauses up to a cap."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(float(cap))).cast("long")


def reconnect_seconds(attempt: Column, base: int = 5, cap: int = 120) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(float(cap))).cast("long")


def era_dimension(spark: SparkSession) -> DataFrame:
    """Eras with the range of epochs each holds; the last has no end."""
    ends = [s for _, s in ERA_EPOCHS[1:]] + [None]
    return spark.createDataFrame([(n, s, e) for (n, s), e in zip(ERA_EPOCHS, ends, strict=True)], "era string, first_epoch long, end_epoch long")
