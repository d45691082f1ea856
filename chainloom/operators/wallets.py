"""Wallet connections: who spent an output, and who received one of the spending transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Addresses longer than this take no part in incremental connections.
LONGEST_ADDRESS = 256


def transfers(tx_ins: DataFrame, tx_outs: DataFrame, txes: DataFrame) -> DataFrame:
    """One row for each spent output and output of the spending transaction that go to different addresses.

    Inputs find the outputs they spend by (transaction, index), and the spending transaction gives its outputs and slot:
    three equi-joins; only the inequality of the addresses is left for afterwards.
    """
    spent = tx_outs.select(F.col("tx_hash").alias("tx_out_hash"), F.col("idx").alias("tx_out_index"), F.col("address").alias("sender"))
    received = tx_outs.select(F.col("tx_hash").alias("tx_in_hash"), F.col("idx").alias("out_index"), F.col("address").alias("receiver"), "value")
    slots = txes.select(F.col("tx_hash").alias("tx_in_hash"), "slot_no")
    return tx_ins.join(spent, ["tx_out_hash", "tx_out_index"]).join(received, "tx_in_hash").join(slots, "tx_in_hash").where("sender <> receiver").withColumnRenamed("tx_in_hash", "tx_hash")


def _by_edge(rows: DataFrame, parts: int | None) -> DataFrame:
    """Rows dealt by edge to so many parts, or by Spark's own choice: most edges have few rows, so that nothing is summed up before."""
    return rows.repartition(parts, "sender", "receiver") if parts else rows


def connections(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Edges of the backfill: distinct transactions, value summed over every pair of input and output.

    Edges are summed up within each transaction first, where its rows lie, so that each counts once."""
    own = rows.groupBy("tx_hash", "sender", "receiver").agg(F.sum("value").alias("value"), F.min("slot_no").alias("first"), F.max("slot_no").alias("last"))
    edge = _by_edge(own, parts).groupBy("sender", "receiver")
    return edge.agg(F.count("tx_hash").alias("total_tx_count"), F.sum("value").alias("total_sent"), F.min("first").alias("first_tx_slot"), F.max("last").alias("last_tx_slot"), F.max("tx_hash").alias("last_tx_hash"))


def distinct_senders(rows: DataFrame) -> DataFrame:
    """One row for each sender of a transaction and output received in it, however many inputs the sender has."""
    return rows.select("sender", "receiver", "tx_hash", "out_index", "value", "slot_no").distinct()


def incremental(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Edges as they grow block by block: one count for each output received, senders once in a transaction.

    The last transaction is the one with the highest slot, ties in favour of the larger hash.
    """
    once = distinct_senders(rows).where((F.length(F.col("sender").cast("string")) <= LONGEST_ADDRESS) & (F.length(F.col("receiver").cast("string")) <= LONGEST_ADDRESS))
    return _by_edge(once, parts).groupBy("sender", "receiver").agg(F.count(F.lit(1)).alias("total_tx_count"), F.sum("value").alias("total_sent"), F.min("slot_no").alias("first_tx_slot"), F.max("slot_no").alias("last_tx_slot"), F.max(F.struct("slot_no", "tx_hash"))["tx_hash"].alias("last_tx_hash"))


def merge_edges(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Add a delta of edges to stored ones: counts and sums add up, slots widen, the later transaction is the last."""
    both = old.unionByName(delta)
    return both.groupBy("sender", "receiver").agg(F.sum("total_tx_count").alias("total_tx_count"), F.sum("total_sent").alias("total_sent"), F.min("first_tx_slot").alias("first_tx_slot"), F.max("last_tx_slot").alias("last_tx_slot"), F.max(F.struct("last_tx_slot", "last_tx_hash"))["last_tx_hash"].alias("last_tx_hash"))
