"""Star-schema tables as ledger tables: blocks, transactions, outputs, inputs, stake and metadata rows.

Orders are transactions, order days are blocks, line items are outputs, suppliers are addresses and pools, customers
are stake addresses. Amounts are integers, so that sums do not depend on their order. ``VIEWS`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainloom import folders

SLOTS_A_DAY, SLOTS_AN_EPOCH = 86400, 432000
FIRST_DAY = "1992-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("long")


def slot_of_day(name: str) -> Column:
    return F.datediff(F.to_date(name), F.to_date(F.lit(FIRST_DAY))).cast("long") * SLOTS_A_DAY


def epoch_of(slot: Column) -> Column:
    """Whole epochs before a slot of the driver's calendar."""
    return F.floor(slot / SLOTS_AN_EPOCH).cast("long")


def txes(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = slot_of_day("o_orderdate")
    deposit = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(2_000_000).cast("long"))  # no deposit is null, not 0
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tx_hash"), slot.alias("slot_no"), epoch_of(slot).alias("epoch_no"), F.col("o_custkey").alias("stake_addr"), F.floor(cents("o_totalprice") / 1000).cast("long").alias("fee"), deposit.alias("deposit"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = txes(spark, sf_dir).groupBy("slot_no", "epoch_no").agg(F.count(F.lit(1)).alias("tx_count"))
    return found.withColumn("block_no", F.floor(F.col("slot_no") / SLOTS_A_DAY).cast("long"))


#: Bytes of stored line items that a task gets at most, on average.
PART_BYTES = 4 << 20


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts that items are dealt to: as many as the session asks for, and more where a task's share would grow with the table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), folders.size(spark, f"{sf_dir}/lineitem.parquet") // PART_BYTES)


def tx_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").repartition(parts(spark, sf_dir), "l_orderkey")
    order = Window.partitionBy("l_orderkey").orderBy(*[c for c in items.columns if c != "l_orderkey"])
    return items.select(F.col("l_orderkey").alias("tx_hash"), (F.row_number().over(order) - 1).cast("long").alias("idx"), F.col("l_suppkey").alias("address"), cents("l_extendedprice").alias("value"), F.col("l_returnflag").alias("flag"))


def tx_ins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned items are spent by the next transaction: its hash, and the output that it spends."""
    return spending(tx_outs(spark, sf_dir))


def spending(outs: DataFrame) -> DataFrame:
    """The inputs that spend outputs."""
    return outs.where("flag = 'R'").select((F.col("tx_hash") + 1).alias("tx_in_hash"), F.col("tx_hash").alias("tx_out_hash"), F.col("idx").alias("tx_out_index"))


def withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("tx_hash"), F.col("o_custkey").alias("addr"), F.floor(cents("o_totalprice") / 100).cast("long").alias("amount"))


def pool_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update of every pool, and a later one of pools with an even key."""
    pools = table(spark, sf_dir, "supplier").withColumn("version", F.explode(F.array(F.lit(0), F.lit(1)))).where("version = 0 or s_suppkey % 2 = 0")
    return pools.select(F.col("s_suppkey").alias("pool"), (cents("s_acctbal") + F.col("version") * 1000).alias("pledge"), (F.col("s_suppkey") * 20).alias("reward_addr"), (F.col("s_suppkey") % 10).cast("long").alias("margin_percent"), F.lit(340_000_000).cast("long").alias("cost"), F.when(F.col("version") == 0, 300).otherwise(450).cast("long").alias("active_epoch"))


def pool_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = epoch_of(slot_of_day("l_shipdate"))
    made = F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 7 != 0), 1).otherwise(0)).cast("long")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("pool"), epoch.alias("epoch_no")).agg(F.sum(cents("l_extendedprice")).alias("stake"), made.alias("blk_cnt"))


def pool_retires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("pool"), (F.col("s_suppkey") + 380).alias("retiring_epoch"))


def delegations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stake address delegates to each pool it buys from, two epochs after the first time."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx_hash"), F.col("l_suppkey").alias("pool"))
    first = items.join(txes(spark, sf_dir).select("tx_hash", "stake_addr", "slot_no"), "tx_hash").groupBy(F.col("stake_addr").alias("addr"), "pool").agg(F.min("slot_no").alias("slot_no"))
    return first.withColumn("active_epoch", epoch_of(F.col("slot_no")) + 2)


def deregistrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P' and o_orderpriority = '5-LOW' and o_custkey % 3 = 0").select(F.col("o_custkey").alias("addr"), F.col("o_orderkey").alias("tx_hash"))


def stake_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("addr"))


def tx_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("tx_hash"), F.col("event_type").alias("key"), F.col("props").alias("json"))


VIEWS = """WITH txes AS (
  SELECT o_orderkey AS tx_hash, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS slot_no,
    (CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400) // 432000 AS epoch_no, o_custkey AS stake_addr,
    CAST(round(o_totalprice * 100) AS BIGINT) // 1000 AS fee, CASE WHEN o_orderpriority = '1-URGENT' THEN 2000000 END AS deposit
  FROM orders),
blocks AS (SELECT slot_no, epoch_no, count(*) AS tx_count, slot_no // 86400 AS block_no FROM txes GROUP BY slot_no, epoch_no),
tx_outs AS (
  SELECT l_orderkey AS tx_hash, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS idx, l_suppkey AS address,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS value, l_returnflag AS flag FROM lineitem),
tx_ins AS (SELECT tx_hash + 1 AS tx_in_hash, tx_hash AS tx_out_hash, idx AS tx_out_index FROM tx_outs WHERE flag = 'R'),
withdrawals AS (SELECT o_orderkey AS tx_hash, o_custkey AS addr, CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS amount FROM orders WHERE o_orderstatus = 'F'),
pool_updates AS (
  SELECT s_suppkey AS pool, CAST(round(s_acctbal * 100) AS BIGINT) + version * 1000 AS pledge, s_suppkey * 20 AS reward_addr,
    s_suppkey % 10 AS margin_percent, CAST(340000000 AS BIGINT) AS cost, CAST(CASE WHEN version = 0 THEN 300 ELSE 450 END AS BIGINT) AS active_epoch
  FROM supplier, (VALUES (0), (1)) v(version) WHERE version = 0 OR s_suppkey % 2 = 0),
pool_stats AS (
  SELECT l_suppkey AS pool, (CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400) // 432000 AS epoch_no,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS stake,
    CAST(sum(CASE WHEN l_linestatus = 'F' AND l_suppkey % 7 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS blk_cnt FROM lineitem GROUP BY 1, 2),
pool_retires AS (SELECT s_suppkey AS pool, s_suppkey + 380 AS retiring_epoch FROM supplier WHERE s_acctbal < 0),
delegations AS (
  SELECT stake_addr AS addr, l_suppkey AS pool, min(slot_no) AS slot_no, min(slot_no) // 432000 + 2 AS active_epoch
  FROM lineitem JOIN txes ON l_orderkey = tx_hash GROUP BY 1, 2),
deregistrations AS (SELECT o_custkey AS addr, o_orderkey AS tx_hash FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND o_custkey % 3 = 0),
stake_addresses AS (SELECT c_custkey AS addr FROM customer),
tx_metadata AS (SELECT event_id, user_id AS tx_hash, event_type AS key, props AS json FROM events)
"""
