"""The chain's tables stored for its joins: dealt into buckets by transaction, once, so that joins shuffle nothing.

Outputs and transactions are dealt and sorted by their transaction, inputs by the transaction whose output they spend. A
join on the transaction then reads bucket beside bucket. Only what is keyed otherwise is shuffled: inputs by the spending
transaction, a few numbers a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import folders
from chainloom.sources import ledger
from chainloom.sources.blocks import fingerprint

#: Table and the transaction that it is dealt by.
DEALT_BY = {"txes": "tx_hash", "tx_outs": "tx_hash", "tx_ins": "tx_out_hash"}


@dataclass(frozen=True)
class Bucketed:
    """Names of the stored tables in the session's catalogue."""

    txes: str
    tx_outs: str
    tx_ins: str

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: spark.table(getattr(self, name)) for name in DEALT_BY}


def store(tables: dict[str, DataFrame], where: str, prefix: str, buckets: int) -> dict[str, str]:
    """Write tables as buckets in folder ``where`` and enter them in the catalogue under ``prefix``; their names there.

    Each task holds whole buckets when it writes, so that there is one file for each bucket.
    """
    names = {}
    for name in tables:
        key = DEALT_BY[name]
        names[name] = f"{prefix}_{name}"
        rows = tables[name].repartition(buckets, key)
        rows.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", f"{where}/{name}").bucketBy(buckets, key).sortBy(key).saveAsTable(names[name])
    return names


_STORED: dict[tuple[str, str], Bucketed] = {}


def bucketed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ledger's tables in buckets, stored once for each application and state of the files."""
    key = (spark.sparkContext.applicationId, fingerprint(spark, sf_dir, ["orders", "lineitem"]))
    if key not in _STORED:
        where, prefix, buckets = folders.new(spark, "buckets"), f"chain_{key[1][:12]}", ledger.parts(spark, sf_dir)
        names = store({"txes": ledger.txes(spark, sf_dir), "tx_outs": ledger.tx_outs(spark, sf_dir)}, where, prefix, buckets)
        # inputs are made of the stored outputs, whose places are not told a second time
        names |= store({"tx_ins": ledger.spending(spark.table(names["tx_outs"]))}, where, prefix, buckets)
        _STORED[key] = Bucketed(**names)
    return _STORED[key].tables(spark)


def _pair(a: str, b: str) -> Column:
    """Equality of two indexes as a condition on pairs of rows: tables are dealt by transaction alone, and a second key
    would deal them anew. A transaction has few outputs."""
    return F.col(a) - F.col(b) == 0


def unspent(tx_outs: DataFrame, tx_ins: DataFrame) -> DataFrame:
    """Outputs that no input names."""
    spent = tx_ins.select("tx_out_hash", "tx_out_index")
    return tx_outs.join(spent, (F.col("tx_hash") == F.col("tx_out_hash")) & _pair("idx", "tx_out_index"), "left_anti")


def transfers(tx_ins: DataFrame, tx_outs: DataFrame, txes: DataFrame) -> DataFrame:
    """As ``wallets.transfers``: inputs meet what they spend in their buckets, and then go to the spending transaction's."""
    spent = tx_outs.select(F.col("tx_hash").alias("spent_hash"), "idx", F.col("address").alias("sender"))
    inputs = tx_ins.join(spent, (F.col("tx_out_hash") == F.col("spent_hash")) & _pair("tx_out_index", "idx")).select(F.col("tx_in_hash").alias("tx_hash"), "sender")
    received = tx_outs.select("tx_hash", F.col("idx").alias("out_index"), F.col("address").alias("receiver"), "value")
    return inputs.join(received.join(txes.select("tx_hash", "slot_no"), "tx_hash"), "tx_hash").where("sender <> receiver")


def standing_after(tables: dict[str, DataFrame], slot: int) -> dict[str, DataFrame]:
    """Transactions up to a slot and their outputs; inputs go by the spending transaction."""
    txes = tables["txes"].where(F.col("slot_no") <= slot)
    stay = txes.select("tx_hash")
    spending = stay.withColumnRenamed("tx_hash", "tx_in_hash")
    return {"txes": txes, "tx_outs": tables["tx_outs"].join(stay, "tx_hash", "left_semi"), "tx_ins": tables["tx_ins"].join(spending, "tx_in_hash", "left_semi")}
