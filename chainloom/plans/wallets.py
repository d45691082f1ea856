"""Queries of wallet connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainloom.operators import wallets as op
from chainloom.plans.register import query
from chainloom.sources import ledger

_TRANSFERS = """WITH transfers AS (
  SELECT s.address AS sender, r.address AS receiver, i.tx_in_hash AS tx_hash, r.idx AS out_index, r.value, t.slot_no
  FROM tx_ins i JOIN tx_outs s ON s.tx_hash = i.tx_out_hash AND s.idx = i.tx_out_index
  JOIN tx_outs r ON r.tx_hash = i.tx_in_hash JOIN txes t ON t.tx_hash = i.tx_in_hash WHERE s.address <> r.address)
"""


def _transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.transfers(ledger.tx_ins(spark, sf_dir), ledger.tx_outs(spark, sf_dir), ledger.txes(spark, sf_dir))


@query(_TRANSFERS + """SELECT sender, receiver, count(DISTINCT tx_hash) AS total_tx_count, CAST(sum(value) AS BIGINT) AS total_sent,
  min(slot_no) AS first_tx_slot, max(slot_no) AS last_tx_slot, max(tx_hash) AS last_tx_hash FROM transfers GROUP BY ALL""")
def wallet_conn_backfill(spark, sf_dir):
    return op.connections(_transfers(spark, sf_dir), ledger.parts(spark, sf_dir))


@query(_TRANSFERS + "SELECT DISTINCT sender, receiver, tx_hash, out_index, value, slot_no FROM transfers")
def wallet_conn_tx_timeline(spark, sf_dir):
    return op.distinct_senders(_transfers(spark, sf_dir))


_INCREMENTAL = _TRANSFERS + """, once AS (SELECT DISTINCT sender, receiver, tx_hash, out_index, value, slot_no FROM transfers)
SELECT sender, receiver, count(*) AS total_tx_count, CAST(sum(value) AS BIGINT) AS total_sent, min(slot_no) AS first_tx_slot,
  max(slot_no) AS last_tx_slot, arg_max(tx_hash, slot_no * 1000000000 + tx_hash) AS last_tx_hash FROM once GROUP BY ALL"""


@query(_INCREMENTAL)
def wallet_conn_incremental(spark, sf_dir):
    return op.incremental(_transfers(spark, sf_dir), ledger.parts(spark, sf_dir))


@query(_INCREMENTAL)
def wallet_conn_merged(spark, sf_dir):
    """Edges of the first half of the chain, with those of the second half merged into them: the same as at once."""
    rows, parts = _transfers(spark, sf_dir), ledger.parts(spark, sf_dir)
    return op.merge_edges(op.incremental(rows.where("slot_no < 190000000"), parts), op.incremental(rows.where("slot_no >= 190000000"), parts))


@query(_TRANSFERS + """SELECT sender AS address, count(DISTINCT receiver) AS receivers, count(DISTINCT tx_hash) AS transactions
FROM transfers GROUP BY sender""")
def wallet_out_degree(spark, sf_dir):
    from pyspark.sql import functions as F

    return _transfers(spark, sf_dir).groupBy(F.col("sender").alias("address")).agg(F.countDistinct("receiver").alias("receivers"), F.countDistinct("tx_hash").alias("transactions"))
