"""Queries of pools, delegations, rewards, refunds and governance stake."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.operators import rewards as op
from chainloom.operators import utxo
from chainloom.plans.register import query
from chainloom.sources import ledger

EPOCH = 460
_POT = "CAST(trunc(CAST(trunc(45e15 * greatest(1e0 - CAST({e} AS DOUBLE) * 2e-3, 3e-1)) AS BIGINT) * 3e-3) AS BIGINT)"
_ACTIVE = f"""WITH active AS (
  SELECT DISTINCT u.pool, u.pledge, u.reward_addr, u.margin_percent, u.cost, u.active_epoch, coalesce(s.stake, 0) AS stake, coalesce(s.blk_cnt, 0) AS blocks_made
  FROM supplier h JOIN pool_updates u ON u.pool = h.s_suppkey LEFT JOIN pool_stats s ON s.pool = u.pool AND s.epoch_no = {EPOCH}
  WHERE u.active_epoch <= {EPOCH} AND NOT EXISTS (SELECT 1 FROM pool_retires r WHERE r.pool = u.pool AND r.retiring_epoch <= {EPOCH})),
latest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY active_epoch DESC, pledge DESC, reward_addr) AS n FROM active) WHERE n = 1),
gone AS (SELECT DISTINCT addr FROM deregistrations WHERE tx_hash IN (SELECT tx_hash FROM txes WHERE epoch_no <= {EPOCH})),
owned AS (SELECT t.stake_addr AS addr, o.tx_hash, o.idx, o.value FROM tx_outs o JOIN txes t ON t.tx_hash = o.tx_hash),
raw AS (SELECT d.pool, d.addr, CAST(sum(o.value) AS BIGINT) AS amount FROM delegations d JOIN owned o ON o.addr = d.addr
  WHERE d.active_epoch <= {EPOCH} AND d.addr NOT IN (SELECT addr FROM gone) GROUP BY 1, 2),
newest AS (SELECT addr, pool FROM (SELECT *, row_number() OVER (PARTITION BY addr ORDER BY slot_no DESC, pool) AS n FROM delegations WHERE active_epoch <= {EPOCH}) WHERE n = 1),
current_ AS (SELECT d.pool, d.addr, CAST(sum(o.value) AS BIGINT) AS amount FROM newest d JOIN owned o ON o.addr = d.addr
  WHERE NOT EXISTS (SELECT 1 FROM tx_ins i WHERE i.tx_out_hash = o.tx_hash AND i.tx_out_index = o.idx) AND d.addr NOT IN (SELECT addr FROM gone) GROUP BY 1, 2),
total AS (SELECT CAST(sum(stake) AS BIGINT) AS total_stake FROM pool_stats WHERE epoch_no = {EPOCH}),
pot AS (SELECT {_POT.format(e=EPOCH)} AS pot),
r1 AS (SELECT l.*, total_stake, CASE WHEN blocks_made > 0 THEN CAST(trunc(CAST(pot - CAST(trunc(pot * 2e-1) AS BIGINT) AS DOUBLE) * (CAST(stake AS DOUBLE) / CAST(total_stake AS DOUBLE))) AS BIGINT) ELSE 0 END AS reward
  FROM latest l, total, pot WHERE total_stake > 0 AND stake > 0),
r2 AS (SELECT *, cost + CASE WHEN reward > cost THEN CAST(trunc(CAST(reward - cost AS DOUBLE) * (margin_percent / 100e0)) AS BIGINT) ELSE 0 END AS operator FROM r1),
rewarded AS (SELECT *, greatest(reward - operator, 0) AS members, least(operator, reward) AS operator_capped FROM r2),
shares AS (SELECT s.pool, s.addr, CAST(trunc(CAST(p.members AS DOUBLE) * (CAST(s.amount AS DOUBLE) / CAST(sum(s.amount) OVER (PARTITION BY s.pool) AS DOUBLE))) AS BIGINT) AS amount
  FROM raw s JOIN rewarded p ON p.pool = s.pool AND p.members > 0),
dealt AS (SELECT * FROM shares WHERE amount > 0)
"""


@query("SELECT DISTINCT epoch_no, " + _POT.format(e="epoch_no") + " AS pot, CAST(trunc(" + _POT.format(e="epoch_no") + " * 2e-1) AS BIGINT) AS treasury FROM blocks")
def reward_pot(spark, sf_dir):
    pot = op.reward_pot(F.col("epoch_no"))
    return ledger.blocks(spark, sf_dir).select("epoch_no").distinct().select("epoch_no", pot.alias("pot"), op.treasury_part(pot).alias("treasury"))


def _active(spark, sf_dir):
    pools = ledger.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pool"))
    return op.active_pools(pools, ledger.pool_updates(spark, sf_dir), ledger.pool_stats(spark, sf_dir), ledger.pool_retires(spark, sf_dir), EPOCH)


@query(_ACTIVE + "SELECT * FROM active")
def active_pools(spark, sf_dir):
    return _active(spark, sf_dir)


@query(_ACTIVE + "SELECT * FROM latest")
def active_pools_latest(spark, sf_dir):
    return op.latest_updates(_active(spark, sf_dir))


@query(f"""SELECT pool, stake, CAST(sum(stake) OVER () AS BIGINT) AS total, CAST(stake AS DOUBLE) / CAST(sum(stake) OVER () AS DOUBLE) AS share
FROM pool_stats WHERE epoch_no = {EPOCH}""")
def pool_stake_share(spark, sf_dir):
    rows = ledger.pool_stats(spark, sf_dir).where(F.col("epoch_no") == EPOCH)
    total = F.broadcast(rows.agg(F.sum("stake").alias("total")))
    return rows.crossJoin(total).select("pool", "stake", "total", (F.col("stake").cast("double") / F.col("total").cast("double")).alias("share"))


@query("SELECT pool, epoch_no, stake, blk_cnt FROM pool_stats")
def pool_stats(spark, sf_dir):
    return ledger.pool_stats(spark, sf_dir)


def _gone(spark, sf_dir):
    return op.gone_addresses(ledger.deregistrations(spark, sf_dir), ledger.txes(spark, sf_dir), EPOCH)


def _owned(outs, spark, sf_dir):
    return outs.join(ledger.txes(spark, sf_dir).select("tx_hash", F.col("stake_addr").alias("addr")), "tx_hash")


@query(_ACTIVE + "SELECT * FROM raw")
def delegator_stake_raw(spark, sf_dir):
    items = ledger.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx_hash"), ledger.cents("l_extendedprice").alias("value"))
    return op.delegator_stake_raw(ledger.delegations(spark, sf_dir), _owned(items, spark, sf_dir), _gone(spark, sf_dir), EPOCH)


@query(_ACTIVE + "SELECT * FROM current_")
def delegator_stake_current(spark, sf_dir):
    left = utxo.unspent(ledger.tx_outs(spark, sf_dir), ledger.tx_ins(spark, sf_dir))
    return op.delegator_stake_current(ledger.delegations(spark, sf_dir), _owned(left, spark, sf_dir), _gone(spark, sf_dir), EPOCH)


@query(_ACTIVE + "SELECT pool, stake, blocks_made, reward, operator, members, operator_capped FROM rewarded")
def pool_rewards(spark, sf_dir):
    return _rewarded(spark, sf_dir).select("pool", "stake", "blocks_made", "reward", "operator", "members", "operator_capped")


def _rewarded(spark, sf_dir):
    return op.pool_rewards(active_pools_latest(spark, sf_dir), ledger.pool_stats(spark, sf_dir), EPOCH)


@query(_ACTIVE + "SELECT * FROM dealt")
def member_rewards(spark, sf_dir):
    return op.member_rewards(_rewarded(spark, sf_dir), delegator_stake_raw(spark, sf_dir))


@query(_ACTIVE + f""", known AS (SELECT * FROM rewarded WHERE reward_addr IN (SELECT addr FROM stake_addresses)),
rows_ AS (SELECT reward_addr AS addr, 'leader' AS type, operator AS amount, pool FROM known WHERE operator > 0
  UNION ALL SELECT addr, 'member', amount, pool FROM dealt WHERE pool IN (SELECT pool FROM known) AND addr IN (SELECT addr FROM stake_addresses)
  UNION ALL SELECT NULL, 'treasury', CAST(trunc(pot * 2e-1) AS BIGINT), NULL FROM pot)
SELECT *, CAST({EPOCH - 2} AS BIGINT) AS earned_epoch, CAST({EPOCH + 1} AS BIGINT) AS spendable_epoch FROM rows_""")
def epoch_rewards(spark, sf_dir):
    return op.epoch_rewards(_rewarded(spark, sf_dir), member_rewards(spark, sf_dir), ledger.stake_addresses(spark, sf_dir), EPOCH)


@query(f"""SELECT DISTINCT d.addr, 'refund' AS type, CAST(2000000 AS BIGINT) AS amount, CAST({EPOCH - 2} AS BIGINT) AS earned_epoch, CAST({EPOCH} AS BIGINT) AS spendable_epoch
FROM deregistrations d JOIN txes t ON t.tx_hash = d.tx_hash WHERE t.epoch_no = {EPOCH - 2} AND d.addr IN (SELECT addr FROM stake_addresses)""")
def refunds(spark, sf_dir):
    return op.refunds(ledger.deregistrations(spark, sf_dir), ledger.txes(spark, sf_dir), ledger.stake_addresses(spark, sf_dir), EPOCH)


@query("""SELECT l_suppkey % 20 AS drep, epoch_no, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem JOIN txes ON tx_hash = l_orderkey GROUP BY 1, 2""")
def drep_distribution(spark, sf_dir):
    """Amounts delegated to each representative in each epoch; the source of the amounts is a parameter of the join."""
    items = ledger.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx_hash"), (F.col("l_suppkey") % 20).alias("drep"), ledger.cents("l_extendedprice").alias("amount"))
    return items.join(ledger.txes(spark, sf_dir).select("tx_hash", "epoch_no"), "tx_hash").groupBy("drep", "epoch_no").agg(F.sum("amount").alias("amount"))


@query("SELECT count(*) AS withdrawals, CAST(coalesce(sum(amount), 0) AS BIGINT) AS total, count(DISTINCT addr) AS addresses FROM withdrawals")
def withdrawal_stats(spark, sf_dir):
    return ledger.withdrawals(spark, sf_dir).agg(F.count(F.lit(1)).alias("withdrawals"), F.coalesce(F.sum("amount"), F.lit(0)).alias("total"), F.countDistinct("addr").alias("addresses"))


@query("""SELECT pool, epoch_no, greatest(stake - 340000000, 0) - CAST(trunc(CAST(greatest(stake - 340000000, 0) AS DOUBLE) * 5e-2) AS BIGINT) AS reward,
  CAST((CAST(blk_cnt AS HUGEINT) * 45000000000000000) // (blk_cnt + 7) AS BIGINT) AS amount FROM pool_stats""")
def simple_rewards(spark, sf_dir):
    return ledger.pool_stats(spark, sf_dir).select("pool", "epoch_no", op.simple_member_reward(F.col("stake"), F.lit(340_000_000).cast("long")).alias("reward"), op.stake_amount(F.col("blk_cnt"), F.col("blk_cnt") + 7).alias("amount"))


@query("""SELECT DISTINCT addr FROM withdrawals WHERE addr IN (SELECT addr FROM deregistrations)""")
def purge_semi_join(spark, sf_dir):
    return ledger.withdrawals(spark, sf_dir).join(ledger.deregistrations(spark, sf_dir), "addr", "left_semi").select("addr").distinct()


@query("SELECT pool, count(*) AS delegators, min(active_epoch) AS first_epoch FROM delegations GROUP BY 1")
def pool_delegators(spark, sf_dir):
    return ledger.delegations(spark, sf_dir).groupBy("pool").agg(F.count(F.lit(1)).alias("delegators"), F.min("active_epoch").alias("first_epoch"))
