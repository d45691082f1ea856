"""Queries of checkpoints, rates and stake snapshots."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainloom.functions import checkpoints, slots
from chainloom.operators import rewards
from chainloom.plans.register import query
from chainloom.sources import ledger


@query("""WITH c AS (SELECT b.epoch_no, max(b.slot_no) AS slot_no, count(*) AS blocks, CAST(sum(b.tx_count) AS BIGINT) AS txes FROM blocks b GROUP BY 1)
SELECT epoch_no, slot_no, '{"blocks":' || blocks || ',"txes":' || txes || '}' AS counts, sha256(concat_ws('|', epoch_no, slot_no, blocks, txes)) AS integrity FROM c""")
def checkpoint_state(spark, sf_dir):
    """A checkpoint for each epoch: its last slot, counts as JSON, and a hash over them."""
    rows = ledger.blocks(spark, sf_dir).groupBy("epoch_no").agg(F.max("slot_no").alias("slot_no"), F.count(F.lit(1)).alias("blocks"), F.sum("tx_count").alias("txes"))
    return rows.select("epoch_no", "slot_no", F.to_json(F.struct("blocks", "txes")).alias("counts"), F.sha2(F.concat_ws("|", "epoch_no", "slot_no", "blocks", "txes"), 256).alias("integrity"))


_ERA = "CASE WHEN slot >= 133660800 THEN 'Conway' WHEN slot >= 72316797 THEN 'Babbage' WHEN slot >= 39916797 THEN 'Alonzo' WHEN slot >= 23068794 THEN 'Mary' WHEN slot >= 16588738 THEN 'Allegra' WHEN slot >= 4492800 THEN 'Shelley' ELSE 'Byron' END"


@query(f"""WITH s AS (SELECT o_orderkey * 9973 AS slot, o_orderstatus FROM orders),
e AS (SELECT CASE WHEN slot < 4492800 THEN slot // 21600 ELSE 208 + (slot - 4492800) // 432000 END AS epoch_no, max(slot) AS slot, count(*) AS blocks, max(slot) - min(slot) AS seconds, bool_and(o_orderstatus = 'F') AS asked FROM s GROUP BY 1),
f AS (SELECT *, {_ERA} AS era, CASE WHEN slot < 4492800 THEN 1506203091 + slot * 20 ELSE 1596059091 + slot - 4492800 END AS made FROM e),
g AS (SELECT *, lag(era) OVER (ORDER BY epoch_no) AS before_, max(made) OVER () AS now_ FROM f)
SELECT epoch_no, CASE WHEN asked THEN 'manual' WHEN before_ IS NULL OR era <> before_ THEN 'era_boundary' ELSE 'block_interval' END AS kind, now_ - made AS age, format('{{}} Era - Slot {{}} (Epoch {{}})', era, slot, epoch_no) AS progress,
  CASE WHEN seconds > 0 THEN printf('%.2f blocks/sec', CAST(blocks AS DOUBLE) / seconds) END AS rate FROM g""", views=False)
def checkpoint_progress(spark, sf_dir):
    """A checkpoint for each epoch in words: its kind, age against the newest, era and rate. One row for each epoch meets
    in the windows."""
    slot = F.col("slot")
    rows = ledger.table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 9973).alias("slot"), "o_orderstatus")
    rows = rows.groupBy(slots.epoch_of_slot(slot).alias("epoch_no")).agg(F.max("slot").alias("slot"), F.count(F.lit(1)).alias("blocks"), (F.max("slot") - F.min("slot")).alias("seconds"), F.min(F.col("o_orderstatus") == "F").alias("asked"))
    rows = rows.withColumns({"era": slots.era_of_slot(slot), "made": slots.time_of_slot(slot)})
    before, now = F.lag("era").over(Window.orderBy("epoch_no")), F.max("made").over(Window.partitionBy(F.lit(0)))
    return rows.select("epoch_no", checkpoints.kind(F.col("era"), before, F.col("asked")).alias("kind"), checkpoints.age_seconds(F.col("made"), now).alias("age"), checkpoints.era_progress(F.col("era"), slot, F.col("epoch_no")).alias("progress"), checkpoints.rate(F.col("blocks"), F.col("seconds")).alias("rate"))


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
r AS (SELECT hour, n, CAST(n AS DOUBLE) / (date_diff('second', lag(hour) OVER (ORDER BY hour), hour)) AS rate FROM h)
SELECT hour, n, rate, max(CASE WHEN rate < 10000 THEN rate END) OVER (ORDER BY hour) AS peak FROM r""", views=False)
def block_rate_peak(spark, sf_dir):
    """Events a second since the hour before, and the highest such rate so far but for wild ones.

    The windows run over one row for each hour that has events.
    """
    hours = ledger.table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("hour")
    since = F.unix_timestamp("hour") - F.unix_timestamp(F.lag("hour").over(order))
    rows = hours.withColumn("rate", F.col("n").cast("double") / since)
    return rows.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "n", "rate", F.max(F.when(F.col("rate") < 10000, F.col("rate"))).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("peak"))


@query("""WITH s AS (SELECT pool, epoch_no, stake, CAST(sum(stake) OVER (PARTITION BY epoch_no) AS BIGINT) AS total FROM pool_stats WHERE pool IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0))
SELECT pool, epoch_no, CAST((CAST(stake AS HUGEINT) * 45000000000000000) // total AS BIGINT) AS amount FROM s""")
def stake_distribution(spark, sf_dir):
    """Each known pool's share of the stake of its epoch, as an exact share of the supply."""
    known = ledger.table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("pool"))
    rows = ledger.pool_stats(spark, sf_dir).join(known, "pool", "left_semi")
    total = rows.groupBy("epoch_no").agg(F.sum("stake").alias("total"))
    return rows.join(total, "epoch_no").select("pool", "epoch_no", rewards.stake_amount(F.col("stake"), F.col("total")).alias("amount"))


@query("""SELECT (SELECT max(slot_no) FROM blocks) AS slot, (SELECT count(*) FROM blocks) AS blocks, (SELECT count(*) FROM txes) AS txes,
(SELECT count(*) FROM events WHERE event_type = 'error') AS errors, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error') AS distinct_errors,
100e0 * (SELECT max(slot_no) FROM blocks WHERE slot_no < 250000000) / (SELECT max(slot_no) FROM blocks) AS percent""")
def dashboard_snapshot(spark, sf_dir):
    """One row with what a status page shows."""
    chain = ledger.blocks(spark, sf_dir).agg(F.max("slot_no").alias("slot"), F.count(F.lit(1)).alias("blocks"), F.sum("tx_count").alias("txes"), F.max(F.when(F.col("slot_no") < 250_000_000, F.col("slot_no"))).alias("done"))
    failed = ledger.table(spark, sf_dir, "events").where("event_type = 'error'").agg(F.count(F.lit(1)).alias("errors"), F.countDistinct("user_id").alias("distinct_errors"))
    return chain.crossJoin(failed).select("slot", "blocks", "txes", "errors", "distinct_errors", (F.lit(100.0) * F.col("done") / F.col("slot")).alias("percent"))
