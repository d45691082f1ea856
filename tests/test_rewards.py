"""Shares of the supply at amounts of large ledgers."""

from pyspark.sql import functions as F

from chainloom.operators import rewards


def test_a_share_just_below_an_integer_is_cut(spark):
    rows = []
    for total in (1_000_000_007, 9_999_999_967, 98_765_432_111):
        stake = -pow(rewards.SUPPLY, -1, total) % total  # the remainder is the largest there is
        rows += [(stake, total, stake * rewards.SUPPLY // total), (total, total, rewards.SUPPLY), (total // 3, total, total // 3 * rewards.SUPPLY // total)]
    frame = spark.createDataFrame(rows, "stake long, total long, expected long")
    found = frame.select(rewards.stake_amount(F.col("stake"), F.col("total")).alias("amount"), "expected").collect()
    assert [r["amount"] for r in found] == [r["expected"] for r in found]
