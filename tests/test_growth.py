"""What a task gets does not grow with the table, and wide rows are shuffled once."""

import os

import pytest
from pyspark.sql import functions as F

from chainloom.operators import wallets
from chainloom.sources import ledger

DATA = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_items_go_to_more_parts_where_there_are_more(spark, monkeypatch):
    assert ledger.parts(spark, DATA) == 4
    monkeypatch.setattr(ledger, "PART_BYTES", os.path.getsize(f"{DATA}/lineitem.parquet") // 30)
    assert ledger.parts(spark, DATA) in (30, 31)
    rows = wallets.transfers(ledger.tx_ins(spark, DATA), ledger.tx_outs(spark, DATA), ledger.txes(spark, DATA))
    for frame in (ledger.tx_outs(spark, DATA), wallets.connections(rows, ledger.parts(spark, DATA)), wallets.incremental(rows, ledger.parts(spark, DATA))):
        assert frame.rdd.getNumPartitions() in (30, 31)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_edges_are_summed_up_where_a_transaction_lies(spark):
    rows = wallets.transfers(ledger.tx_ins(spark, DATA), ledger.tx_outs(spark, DATA), ledger.txes(spark, DATA))
    found = wallets.connections(rows, 7)
    assert "Expand" not in plan(found)
    plain = rows.groupBy("sender", "receiver").agg(F.countDistinct("tx_hash"), F.sum("value"), F.min("slot_no"), F.max("slot_no"), F.max("tx_hash"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
