"""Selective indexing: rows of the assets, addresses, pools, metadata keys and ranges of slots that are asked for."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Selection:
    """Empty lists and missing bounds select everything; several conditions must all hold."""

    addresses: list[str] = field(default_factory=list)
    policies: list[str] = field(default_factory=list)
    metadata_keys: list[int] = field(default_factory=list)
    first_slot: int | None = None
    last_slot: int | None = None


def blocks_in_range(raw: DataFrame, chosen: Selection) -> DataFrame:
    """Blocks within the bounds; on Parquet these reach the scan."""
    if chosen.first_slot is not None:
        raw = raw.where(F.col("slot") >= chosen.first_slot)
    if chosen.last_slot is not None:
        raw = raw.where(F.col("slot") <= chosen.last_slot)
    return raw


def wanted(chosen: Selection) -> Column:
    """Whether a nested transaction ``x`` has what is selected."""

    def holds(tx: Column) -> Column:
        found = F.lit(True)
        if chosen.addresses:
            found &= F.exists(F.coalesce(tx["outputs"], F.array()), lambda o: o["address"].isin(chosen.addresses))
        if chosen.policies:
            found &= F.exists(F.coalesce(tx["outputs"], F.array()), lambda o: F.exists(F.map_keys(F.coalesce(o["assets"], F.create_map().cast("map<string,map<string,decimal(20,0)>>"))), lambda p: p.isin(chosen.policies)))
        if chosen.metadata_keys:
            found &= F.exists(F.map_keys(F.coalesce(tx["metadata"], F.create_map().cast("map<decimal(20,0),string>"))), lambda k: k.isin(chosen.metadata_keys))
        return found

    return F.filter("txs", holds)


def select_blocks(raw: DataFrame, chosen: Selection) -> DataFrame:
    """Blocks in range with only the transactions wanted; blocks stay even without any, for the chain's sake."""
    return blocks_in_range(raw, chosen).withColumn("txs", wanted(chosen))
