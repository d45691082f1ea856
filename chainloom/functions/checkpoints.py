"""What a checkpoint is called, how old it is, and its progress in words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed kinds.
ERA_BOUNDARY, BLOCK_INTERVAL, MANUAL = "era_boundary", "block_interval", "manual"


def kind(era: Column, era_before: Column, asked_for: Column) -> Column:
    """The kind of a checkpoint: asked for by hand, at the first of an era, or after some blocks."""
    return F.when(asked_for, MANUAL).when(era_before.isNull() | (era != era_before), ERA_BOUNDARY).otherwise(BLOCK_INTERVAL)


def is_kind(of: Column, name: str) -> Column:
    return F.coalesce(of == name, F.lit(False))


def age_seconds(made: Column, now: Column) -> Column:
    """Whole seconds since a checkpoint was made, none if it lies ahead."""
    return F.greatest(F.unix_seconds(now) - F.unix_seconds(made), F.lit(0).cast("long"))


def era_progress(era: Column, slot: Column, epoch: Column) -> Column:
    return F.format_string("%s Era - Slot %d (Epoch %d)", era, slot, epoch)


def rate(blocks: Column, seconds: Column) -> Column:
    """Blocks a second in words; null where no time has passed."""
    return F.when(seconds > 0, F.format_string("%.2f blocks/sec", blocks.cast("double") / seconds))
