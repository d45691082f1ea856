"""Unspent outputs, changes of them by epoch, and the pots of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed: all lovelace there will ever be, and the treasury's share of fees from epoch 208 on.
SUPPLY, TREASURY_PERCENT, FIRST_EPOCH = 45_000_000_000_000_000, 20, 208


def unspent(tx_outs: DataFrame, tx_ins: DataFrame) -> DataFrame:
    """Outputs that no input names."""
    spent = tx_ins.select(F.col("tx_out_hash").alias("tx_hash"), F.col("tx_out_index").alias("idx"))
    return tx_outs.join(spent, ["tx_hash", "idx"], "left_anti")


def unspent_in_chain(tx_outs: DataFrame, tx_ins: DataFrame, txes: DataFrame) -> DataFrame:
    """The same, for inputs whose transaction is in the chain."""
    return unspent(tx_outs, tx_ins.join(txes.select(F.col("tx_hash").alias("tx_in_hash")), "tx_in_hash", "left_semi"))


def changes_by_epoch(tx_outs: DataFrame, tx_ins: DataFrame, txes: DataFrame) -> DataFrame:
    """Created and spent outputs and values of each epoch, their difference, and running totals."""
    epochs = txes.select("tx_hash", "epoch_no")
    created = tx_outs.join(epochs, "tx_hash").groupBy("epoch_no").agg(F.count(F.lit(1)).alias("created_count"), F.sum("value").alias("created_value"))
    of_spent = tx_outs.select(F.col("tx_hash").alias("tx_out_hash"), F.col("idx").alias("tx_out_index"), "value")
    spent = tx_ins.join(of_spent, ["tx_out_hash", "tx_out_index"]).join(epochs.withColumnRenamed("tx_hash", "tx_in_hash"), "tx_in_hash").groupBy("epoch_no").agg(F.count(F.lit(1)).alias("spent_count"), F.sum("value").alias("spent_value"))
    both = created.join(spent, "epoch_no", "full").na.fill(0)
    change = both.withColumn("net_change", F.col("created_value") - F.col("spent_value"))
    # one row for each epoch: the running sum over them is small however long the chain is
    return change.withColumn("utxo_value", F.sum("net_change").over(Window.orderBy("epoch_no").rowsBetween(Window.unboundedPreceding, 0)))


def treasury_of(epoch: Column, fees: Column) -> Column:
    return F.when(epoch >= FIRST_EPOCH, F.floor(fees * TREASURY_PERCENT / 100)).otherwise(0).cast("long")


def pots(txes: DataFrame, blocks: DataFrame, withdrawals: DataFrame, utxo_total: DataFrame) -> DataFrame:
    """The pots of every epoch at its last slot. ``utxo_total`` has one row: the value of the unspent outputs now."""
    last = blocks.where(F.col("epoch_no") >= FIRST_EPOCH).groupBy("epoch_no").agg(F.max("slot_no").alias("slot_no"))
    money = txes.groupBy("epoch_no").agg(F.sum("fee").alias("fees"), F.coalesce(F.sum("deposit"), F.lit(0)).alias("deposits"))
    paid = withdrawals.join(txes.select("tx_hash", "epoch_no"), "tx_hash").groupBy("epoch_no").agg(F.sum("amount").alias("paid"))
    rows = last.join(money, "epoch_no", "left").join(paid, "epoch_no", "left").na.fill(0, ["fees", "deposits", "paid"])
    rows = rows.withColumn("rewards", F.sum("paid").over(Window.orderBy("epoch_no").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.crossJoin(F.broadcast(utxo_total.limit(1)))
    rows = rows.withColumn("treasury", treasury_of(F.col("epoch_no"), F.col("fees")))
    return rows.select("slot_no", "epoch_no", "treasury", (F.lit(SUPPLY) - F.col("utxo") - F.col("treasury") - F.col("rewards")).alias("reserves"), "rewards", "utxo", "deposits", "fees")


def cumulative(by_epoch: DataFrame, column: str, name: str) -> DataFrame:
    """A running sum over the epochs of a table that has one row for each."""
    return by_epoch.withColumn(name, F.sum(column).over(Window.orderBy("epoch_no").rowsBetween(Window.unboundedPreceding, 0)))
