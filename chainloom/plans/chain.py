"""Queries over blocks, transactions and outputs: unspent outputs, epochs, pots, slots, eras, reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainloom.functions import slots
from chainloom.operators import utxo
from chainloom.plans.register import query
from chainloom.sources import ledger

_ANTI = "FROM tx_outs o WHERE NOT EXISTS (SELECT 1 FROM tx_ins i WHERE i.tx_out_hash = o.tx_hash AND i.tx_out_index = o.idx)"


@query(f"SELECT tx_hash, idx, address, value {_ANTI}")
def utxo_set(spark, sf_dir):
    return utxo.unspent(ledger.tx_outs(spark, sf_dir), ledger.tx_ins(spark, sf_dir)).drop("flag")


@query(f"SELECT count(*) AS outputs, CAST(coalesce(sum(value), 0) AS BIGINT) AS utxo {_ANTI}")
def utxo_total(spark, sf_dir):
    return utxo_set(spark, sf_dir).agg(F.count(F.lit(1)).alias("outputs"), F.coalesce(F.sum("value"), F.lit(0)).alias("utxo"))


@query(f"SELECT address, count(*) AS outputs, CAST(sum(value) AS BIGINT) AS balance {_ANTI} GROUP BY address")
def address_balances(spark, sf_dir):
    return utxo_set(spark, sf_dir).groupBy("address").agg(F.count(F.lit(1)).alias("outputs"), F.sum("value").alias("balance"))


@query("""WITH created AS (SELECT epoch_no, count(*) AS n, sum(value) AS v FROM tx_outs JOIN txes USING (tx_hash) GROUP BY 1),
spent AS (SELECT t.epoch_no, count(*) AS n, sum(o.value) AS v FROM tx_ins i JOIN tx_outs o ON o.tx_hash = i.tx_out_hash AND o.idx = i.tx_out_index
  JOIN txes t ON t.tx_hash = i.tx_in_hash GROUP BY 1),
both_ AS (SELECT coalesce(c.epoch_no, s.epoch_no) AS epoch_no, coalesce(c.n, 0) AS created_count, CAST(coalesce(c.v, 0) AS BIGINT) AS created_value,
  coalesce(s.n, 0) AS spent_count, CAST(coalesce(s.v, 0) AS BIGINT) AS spent_value FROM created c FULL JOIN spent s ON c.epoch_no = s.epoch_no)
SELECT *, created_value - spent_value AS net_change, CAST(sum(created_value - spent_value) OVER (ORDER BY epoch_no) AS BIGINT) AS utxo_value FROM both_""")
def utxo_delta_by_epoch(spark, sf_dir):
    return utxo.changes_by_epoch(ledger.tx_outs(spark, sf_dir), ledger.tx_ins(spark, sf_dir), ledger.txes(spark, sf_dir))


@query("""SELECT b.epoch_no, min(b.slot_no) AS start_slot, max(b.slot_no) AS end_slot, count(*) AS blk_count, CAST(sum(tx_count) AS BIGINT) AS tx_count,
  max(b.slot_no) - min(b.slot_no) + 1 AS slot_count FROM blocks b GROUP BY 1""")
def epoch_summary(spark, sf_dir):
    return ledger.blocks(spark, sf_dir).groupBy("epoch_no").agg(F.min("slot_no").alias("start_slot"), F.max("slot_no").alias("end_slot"), F.count(F.lit(1)).alias("blk_count"), F.sum("tx_count").alias("tx_count"), (F.max("slot_no") - F.min("slot_no") + 1).alias("slot_count"))


@query("SELECT epoch_no, CAST(coalesce(sum(fee), 0) AS BIGINT) AS fees, CAST(coalesce(sum(deposit), 0) AS BIGINT) AS deposits FROM txes GROUP BY 1")
def epoch_fees(spark, sf_dir):
    zero = F.lit(0)
    return ledger.txes(spark, sf_dir).groupBy("epoch_no").agg(F.coalesce(F.sum("fee"), zero).alias("fees"), F.coalesce(F.sum("deposit"), zero).alias("deposits"))


@query("""WITH paid AS (SELECT epoch_no, CAST(sum(amount) AS BIGINT) AS amount FROM withdrawals JOIN txes USING (tx_hash) GROUP BY 1)
SELECT epoch_no, amount, CAST(sum(amount) OVER (ORDER BY epoch_no) AS BIGINT) AS total FROM paid""")
def epoch_withdrawals_cumulative(spark, sf_dir):
    paid = ledger.withdrawals(spark, sf_dir).join(ledger.txes(spark, sf_dir).select("tx_hash", "epoch_no"), "tx_hash").groupBy("epoch_no").agg(F.sum("amount").alias("amount"))
    return utxo.cumulative(paid, "amount", "total")


@query(f"""WITH u AS (SELECT CAST(coalesce(sum(value), 0) AS BIGINT) AS utxo {_ANTI}),
last AS (SELECT epoch_no, max(slot_no) AS slot_no FROM blocks WHERE epoch_no >= 208 GROUP BY 1),
money AS (SELECT epoch_no, CAST(sum(fee) AS BIGINT) AS fees, CAST(coalesce(sum(deposit), 0) AS BIGINT) AS deposits FROM txes GROUP BY 1),
paid AS (SELECT epoch_no, CAST(sum(amount) AS BIGINT) AS paid FROM withdrawals JOIN txes USING (tx_hash) GROUP BY 1),
rows_ AS (SELECT l.slot_no, l.epoch_no, coalesce(fees, 0) AS fees, coalesce(deposits, 0) AS deposits,
  CAST(sum(coalesce(paid, 0)) OVER (ORDER BY l.epoch_no) AS BIGINT) AS rewards FROM last l LEFT JOIN money USING (epoch_no) LEFT JOIN paid USING (epoch_no))
SELECT slot_no, epoch_no, fees * 20 // 100 AS treasury, 45000000000000000 - utxo - fees * 20 // 100 - rewards AS reserves, rewards, utxo, deposits, fees FROM rows_, u""")
def ada_pots(spark, sf_dir):
    total = utxo_total(spark, sf_dir).select("utxo")
    return utxo.pots(ledger.txes(spark, sf_dir), ledger.blocks(spark, sf_dir), ledger.withdrawals(spark, sf_dir), total)


@query("SELECT epoch_no, max(slot_no) AS slot_no FROM blocks WHERE epoch_no >= 208 GROUP BY 1 ORDER BY 1")
def epoch_last_slot(spark, sf_dir):
    return ledger.blocks(spark, sf_dir).where("epoch_no >= 208").groupBy("epoch_no").agg(F.max("slot_no").alias("slot_no")).orderBy("epoch_no")


@query("SELECT t.tx_hash, CAST(sum(value) AS BIGINT) AS out_sum FROM txes t LEFT JOIN tx_outs o ON o.tx_hash = t.tx_hash GROUP BY 1")
def tx_out_sum(spark, sf_dir):
    sums = ledger.tx_outs(spark, sf_dir).groupBy("tx_hash").agg(F.sum("value").alias("out_sum"))
    return ledger.txes(spark, sf_dir).select("tx_hash").join(sums, "tx_hash", "left")


@query("SELECT slot_no, tx_count FROM blocks")
def block_tx_count(spark, sf_dir):
    return ledger.blocks(spark, sf_dir).select("slot_no", "tx_count")


@query("""SELECT max(slot_no) AS max_slot, max(block_no) AS max_block, max(epoch_no) AS max_epoch, count(*) AS blocks, CAST(sum(tx_count) AS BIGINT) AS txes,
  (SELECT count(*) FROM tx_outs) AS tx_outs, (SELECT count(*) FROM tx_ins) AS tx_ins FROM blocks""")
def sync_status(spark, sf_dir):
    top = ledger.blocks(spark, sf_dir).agg(F.max("slot_no").alias("max_slot"), F.max("block_no").alias("max_block"), F.max("epoch_no").alias("max_epoch"), F.count(F.lit(1)).alias("blocks"), F.sum("tx_count").alias("txes"))
    items = ledger.table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("tx_outs"), F.count_if(F.col("l_returnflag") == "R").alias("tx_ins"))
    return top.crossJoin(items)


@query("""SELECT count(*) AS events, count(*) / 5.0e0 AS per_minute, date_trunc('minute', max(ts)) AS newest FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY""", views=False)
def recent_block_rate(spark, sf_dir):
    """Events of the last day before the newest one, a fifth of them, and the newest one's minute."""
    events = ledger.table(spark, sf_dir, "events")
    newest = F.broadcast(events.agg(F.max("ts").alias("newest")))
    recent = events.join(newest, F.col("ts") > F.col("newest") - F.expr("INTERVAL 1 DAY"))
    return recent.agg(F.count(F.lit(1)).alias("events"), (F.count(F.lit(1)) / F.lit(5.0)).alias("per_minute"), F.date_trunc("minute", F.max("ts")).cast("timestamp_ntz").alias("newest"))


@query("""SELECT epoch_no, count(*) AS txes, CAST(sum(CASE WHEN deposit > 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_deposit,
  round(sum(fee) / 1073741824e0, 2) AS fee_gib FROM txes GROUP BY 1""")
def conditional_counts(spark, sf_dir):
    return ledger.txes(spark, sf_dir).groupBy("epoch_no").agg(F.count(F.lit(1)).alias("txes"), F.sum(F.when(F.col("deposit") > 0, 1).otherwise(0)).alias("with_deposit"), F.round(F.sum("fee") / float(1 << 30), 2).alias("fee_gib"))


@query("SELECT slot_no, epoch_no, block_no, tx_count FROM blocks ORDER BY slot_no DESC LIMIT 1")
def latest_block(spark, sf_dir):
    return ledger.blocks(spark, sf_dir).select("slot_no", "epoch_no", "block_no", "tx_count").orderBy(F.desc("slot_no")).limit(1)


@query("SELECT addr FROM stake_addresses ORDER BY addr LIMIT 100 OFFSET 50")
def paged_scan(spark, sf_dir):
    return ledger.stake_addresses(spark, sf_dir).orderBy("addr").offset(50).limit(100)


_SLOTS = """WITH s AS (SELECT o_orderkey AS tx_hash, o_orderkey * 9973 AS slot FROM orders)"""


def _spread_slots(spark, sf_dir):
    return ledger.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tx_hash"), (F.col("o_orderkey") * 9973).alias("slot"))


@query(_SLOTS + """SELECT tx_hash, slot, CASE WHEN slot < 4492800 THEN slot // 21600 ELSE 208 + (slot - 4492800) // 432000 END AS epoch_no,
  CASE WHEN slot < 4492800 THEN 1506203091 + slot * 20 ELSE 1596059091 + slot - 4492800 END AS unix_time,
  strftime(make_timestamp((CASE WHEN slot < 4492800 THEN 1506203091 + slot * 20 ELSE 1596059091 + slot - 4492800 END) * 1000000), '%Y-%m-%d %H:%M') AS minute,
  CASE WHEN slot >= 133660800 THEN 'Conway' WHEN slot >= 72316797 THEN 'Babbage' WHEN slot >= 39916797 THEN 'Alonzo' WHEN slot >= 23068794 THEN 'Mary'
    WHEN slot >= 16588738 THEN 'Allegra' WHEN slot >= 4492800 THEN 'Shelley' ELSE 'Byron' END AS era FROM s""")
def slot_epoch_time_era(spark, sf_dir):
    slot = F.col("slot")
    return _spread_slots(spark, sf_dir).select("tx_hash", "slot", slots.epoch_of_slot(slot).alias("epoch_no"), slots.unix_time_of_slot(slot).alias("unix_time"), F.date_format(slots.time_of_slot(slot), "yyyy-MM-dd HH:mm").alias("minute"), slots.era_of_slot(slot).alias("era"))


def _progress(start: int, end: int) -> str:
    return f"least(greatest((CAST(slot AS DOUBLE) - {start}) / {end - start} * 100, 0.0e0), 100.0e0)"


@query(_SLOTS + "SELECT tx_hash, slot, " + ", ".join(f"{_progress(s, e)} AS {n.lower()}" for (n, s), (_, e) in zip(slots.ERA_SLOTS, slots.ERA_SLOTS[1:], strict=False)) + ", CASE WHEN slot >= 133660800 THEN 5.0e0 ELSE 0.0e0 END AS conway FROM s")
def era_progress(spark, sf_dir):
    return _spread_slots(spark, sf_dir).select("tx_hash", "slot", *slots.era_progress(F.col("slot")))


@query(_SLOTS + """, m AS (SELECT max(slot) AS tip FROM s) SELECT tx_hash, least(slot * 100.0e0 / tip, 100.0e0) AS percent, greatest(tip - slot, 0) AS behind,
  least(slot * 100.0e0 / tip, 100.0e0) >= 99.9e0 AS synced, 4492800 + greatest(0, 1700000000 + slot - 1596059091) AS estimated_tip FROM s, m WHERE tip > 0""")
def sync_progress(spark, sf_dir):
    rows = _spread_slots(spark, sf_dir)
    rows = rows.crossJoin(F.broadcast(rows.agg(F.max("slot").alias("tip"))))
    percent = slots.sync_percent(F.col("slot"), F.col("tip"))
    return rows.select("tx_hash", percent.alias("percent"), slots.slots_behind(F.col("slot"), F.col("tip")).alias("behind"), (percent >= 99.9).alias("synced"), slots.estimated_tip(F.lit(1_700_000_000) + F.col("slot")).alias("estimated_tip"))


@query("""WITH marked AS (SELECT slot_no, epoch_no, lag(epoch_no) OVER (ORDER BY slot_no) AS before_ FROM blocks)
SELECT slot_no, epoch_no FROM marked WHERE before_ IS NULL OR epoch_no > before_""")
def epoch_boundaries(spark, sf_dir):
    """The first block of each epoch: with blocks in the order of slots, the epoch's smallest slot; no window is needed."""
    return ledger.blocks(spark, sf_dir).groupBy("epoch_no").agg(F.min("slot_no").alias("slot_no")).select("slot_no", "epoch_no")


@query("""SELECT 'blocks' AS name, count(*) AS n FROM blocks UNION ALL SELECT 'txes', count(*) FROM txes
UNION ALL SELECT 'tx_outs', count(*) FROM tx_outs UNION ALL SELECT 'withdrawals', count(*) FROM withdrawals""")
def union_counts(spark, sf_dir):
    parts = None
    for name, rows in (("blocks", ledger.blocks), ("txes", ledger.txes), ("tx_outs", lambda s, d: ledger.table(s, d, "lineitem")), ("withdrawals", ledger.withdrawals)):
        one = rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("""SELECT b.epoch_no, count(*) AS txes, min(t.fee) AS least_fee, max(t.fee) AS most_fee FROM txes t JOIN blocks b ON b.slot_no = t.slot_no
WHERE b.slot_no BETWEEN 130000000 AND 200000000 GROUP BY 1""")
def range_report(spark, sf_dir):
    rows = ledger.txes(spark, sf_dir).drop("epoch_no").join(ledger.blocks(spark, sf_dir).select("slot_no", "epoch_no"), "slot_no").where(F.col("slot_no").between(130_000_000, 200_000_000))
    return rows.groupBy("epoch_no").agg(F.count(F.lit(1)).alias("txes"), F.min("fee").alias("least_fee"), F.max("fee").alias("most_fee"))


@query("""WITH ranked AS (SELECT *, row_number() OVER (ORDER BY slot_no DESC) AS place FROM blocks)
SELECT slot_no, epoch_no, block_no, tx_count, place FROM ranked WHERE place <= 300""")
def recent_ring(spark, sf_dir):
    """The newest 300 blocks, numbered: a top-k first, then a window over no more than those."""
    newest = ledger.blocks(spark, sf_dir).orderBy(F.desc("slot_no")).limit(300)
    return newest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("slot_no"))).cast("long"))


@query("""SELECT t.tx_hash, b.slot_no, b.block_no, t.fee FROM txes t JOIN blocks b ON b.slot_no = t.slot_no WHERE t.tx_hash IN (7, 77, 777)""")
def tx_lookup(spark, sf_dir):
    rows = ledger.txes(spark, sf_dir).where(F.col("tx_hash").isin(7, 77, 777)).select("tx_hash", "slot_no", "fee")
    return rows.join(ledger.blocks(spark, sf_dir).select("slot_no", "block_no"), "slot_no").select("tx_hash", "slot_no", "block_no", "fee")


@query("""SELECT t.tx_hash, count(*) AS inputs, CAST(sum(o.value) AS BIGINT) AS in_sum FROM tx_ins i JOIN tx_outs o ON o.tx_hash = i.tx_out_hash AND o.idx = i.tx_out_index
JOIN txes t ON t.tx_hash = i.tx_in_hash GROUP BY 1""")
def tx_input_values(spark, sf_dir):
    outs = ledger.tx_outs(spark, sf_dir).select(F.col("tx_hash").alias("tx_out_hash"), F.col("idx").alias("tx_out_index"), "value")
    rows = ledger.tx_ins(spark, sf_dir).join(outs, ["tx_out_hash", "tx_out_index"]).withColumnRenamed("tx_in_hash", "tx_hash")
    return rows.join(ledger.txes(spark, sf_dir).select("tx_hash"), "tx_hash", "left_semi").groupBy("tx_hash").agg(F.count(F.lit(1)).alias("inputs"), F.sum("value").alias("in_sum"))
