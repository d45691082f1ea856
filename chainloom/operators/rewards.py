"""Staking: active pools, stake of delegators, pool and member rewards, refunds.

Amounts pass through doubles and are cut to integers after each step, as the published rule does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the simplified reward rule.
SUPPLY = 45_000_000_000_000_000
EXPANSION, TREASURY_TAX, SHRINK, LEAST_RESERVES = 0.003, 0.2, 0.002, 0.3
FIRST_EPOCH, REFUND = 211, 2_000_000


def whole(x: Column) -> Column:
    """Cut a double to an integer towards zero."""
    return x.cast("long")


def reward_pot(epoch: Column) -> Column:
    reserves = whole(F.lit(float(SUPPLY)) * F.greatest(F.lit(1.0) - epoch.cast("double") * SHRINK, F.lit(LEAST_RESERVES)))
    return whole(reserves.cast("double") * EXPANSION)


def treasury_part(pot: Column) -> Column:
    return whole(pot.cast("double") * TREASURY_TAX)


def active_pools(pools: DataFrame, updates: DataFrame, stats: DataFrame, retires: DataFrame, epoch: int) -> DataFrame:
    """Pools with an update in force and no retirement by the epoch, with each such update and the epoch's stake."""
    now = stats.where(F.col("epoch_no") == epoch).select("pool", "stake", "blk_cnt")
    gone = retires.where(F.col("retiring_epoch") <= epoch).select("pool")
    rows = pools.join(updates.where(F.col("active_epoch") <= epoch), "pool").join(now, "pool", "left").join(gone, "pool", "left_anti")
    rows = rows.select("pool", "pledge", "reward_addr", "margin_percent", "cost", "active_epoch", F.coalesce("stake", F.lit(0)).alias("stake"), F.coalesce("blk_cnt", F.lit(0)).alias("blocks_made"))
    return rows.distinct()


def latest_updates(rows: DataFrame) -> DataFrame:
    """Of each pool the update that came into force last."""
    newest = Window.partitionBy("pool").orderBy(F.desc("active_epoch"), F.desc("pledge"), "reward_addr")
    return rows.withColumn("n", F.row_number().over(newest)).where("n = 1").drop("n")


def pool_rewards(pools: DataFrame, stats: DataFrame, epoch: int) -> DataFrame:
    """Each pool's share of the pot after the treasury's part: what its operator takes and what is left for members.

    A pool that made no block has no reward, but its operator still takes the cost; ``operator_capped`` holds what
    the operator takes if that is limited to the reward.
    """
    total = F.broadcast(stats.where(F.col("epoch_no") == epoch).agg(F.sum("stake").alias("total_stake")))
    pot = reward_pot(F.lit(epoch))
    rows = pools.crossJoin(total).where("total_stake > 0 and stake > 0")
    share = F.col("stake").cast("double") / F.col("total_stake").cast("double")
    rows = rows.withColumn("reward", F.when(F.col("blocks_made") > 0, whole((pot - treasury_part(pot)).cast("double") * share)).otherwise(F.lit(0).cast("long")))
    margin = F.when(F.col("reward") > F.col("cost"), whole((F.col("reward") - F.col("cost")).cast("double") * (F.col("margin_percent") / 100.0))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("operator", F.col("cost") + margin)
    return rows.withColumn("members", F.greatest(F.col("reward") - F.col("operator"), F.lit(0).cast("long"))).withColumn("operator_capped", F.least("operator", "reward"))


def gone_addresses(deregistrations: DataFrame, txes: DataFrame, epoch: int) -> DataFrame:
    """Addresses that a transaction up to the epoch has deregistered."""
    return deregistrations.join(txes.where(F.col("epoch_no") <= epoch).select("tx_hash"), "tx_hash", "left_semi").select("addr").distinct()


def delegator_stake_raw(delegations: DataFrame, outs: DataFrame, gone: DataFrame, epoch: int) -> DataFrame:
    """All outputs ever received by each delegator of a pool, spent or not, once for each of the delegations in force."""
    rows = delegations.where(F.col("active_epoch") <= epoch).select("addr", "pool").join(gone, "addr", "left_anti")
    sums = outs.groupBy("addr").agg(F.sum("value").alias("amount"))  # summed before the join, which multiplies rows
    return rows.groupBy("pool", "addr").agg(F.count(F.lit(1)).alias("n")).join(sums, "addr").select("pool", "addr", (F.col("amount") * F.col("n")).alias("amount"))


def delegator_stake_current(delegations: DataFrame, unspent_outs: DataFrame, gone: DataFrame, epoch: int) -> DataFrame:
    """Unspent outputs of each address under its latest delegation only."""
    newest = Window.partitionBy("addr").orderBy(F.desc("slot_no"), "pool")
    rows = delegations.where(F.col("active_epoch") <= epoch).withColumn("n", F.row_number().over(newest)).where("n = 1").select("addr", "pool").join(gone, "addr", "left_anti")
    return rows.join(unspent_outs.groupBy("addr").agg(F.sum("value").alias("amount")), "addr").select("pool", "addr", "amount")


def member_rewards(pools: DataFrame, stake: DataFrame) -> DataFrame:
    """What is left of each pool's reward, dealt out by stake; shares below one are dropped."""
    total = stake.groupBy("pool").agg(F.sum("amount").alias("total"))
    rows = stake.join(pools.where("members > 0").select("pool", "members"), "pool").join(total, "pool").where("total > 0")
    share = F.col("amount").cast("double") / F.col("total").cast("double")
    return rows.select("pool", "addr", whole(F.col("members").cast("double") * share).alias("amount")).where("amount > 0")


def epoch_rewards(pools: DataFrame, members: DataFrame, addresses: DataFrame, epoch: int) -> DataFrame:
    """Reward rows of an epoch: leaders and members with a registered address, and the treasury's part.

    A pool whose reward address is not registered pays neither its leader nor its members.
    """
    known = pools.join(addresses.select(F.col("addr").alias("reward_addr")), "reward_addr", "left_semi")
    leaders = known.where("operator > 0").select(F.col("reward_addr").alias("addr"), F.lit("leader").alias("type"), F.col("operator").alias("amount"), "pool")
    paid = members.join(known.select("pool"), "pool", "left_semi").join(addresses, "addr", "left_semi").select("addr", F.lit("member").alias("type"), "amount", "pool")
    pot = reward_pot(F.lit(epoch))
    rest = addresses.sparkSession.range(1).select(F.lit(None).cast("long").alias("addr"), F.lit("treasury").alias("type"), treasury_part(pot).alias("amount"), F.lit(None).cast("long").alias("pool"))
    rows = leaders.unionByName(paid).unionByName(rest)
    return rows.where(F.lit(epoch >= FIRST_EPOCH)).withColumn("earned_epoch", F.lit(epoch - 2).cast("long")).withColumn("spendable_epoch", F.lit(epoch + 1).cast("long"))


def refunds(deregistrations: DataFrame, txes: DataFrame, addresses: DataFrame, epoch: int) -> DataFrame:
    """The fixed deposit for each address deregistered two epochs ago, spendable now."""
    then = deregistrations.join(txes.where(F.col("epoch_no") == epoch - 2).select("tx_hash"), "tx_hash", "left_semi")
    rows = then.select("addr").distinct().join(addresses, "addr", "left_semi")
    return rows.select("addr", F.lit("refund").alias("type"), F.lit(REFUND).cast("long").alias("amount"), F.lit(epoch - 2).cast("long").alias("earned_epoch"), F.lit(epoch).cast("long").alias("spendable_epoch"))


def simple_member_reward(stake: Column, cost: Column) -> Column:
    """What is over the cost, less five percent cut to an integer."""
    over = F.greatest(stake - cost, F.lit(0).cast("long"))
    return over - whole(over.cast("double") * 0.05)


def stake_amount(numerator: Column, denominator: Column, total: int = SUPPLY) -> Column:
    """A rational share of the supply, cut to an integer; exact in decimals.

    The remainder goes before the division, since a decimal quotient is rounded to six places: it would reach the next integer."""
    product, parts = numerator.cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)"), denominator.cast("decimal(19,0)")
    return F.when(denominator != 0, ((product - F.pmod(product, parts)) / parts).cast("long"))
