import datetime

import pytest
from pyspark.sql import functions as F

from chainloom.functions import messages
from chainloom.operators import errors, offchain, rewards, wallets
from chainloom.streaming import jobs


def test_reward_pot_of_epoch_213(spark):
    row = spark.range(1).select(rewards.reward_pot(F.lit(213)).alias("p")).withColumn("t", rewards.treasury_part(F.col("p"))).first()
    fraction = 1.0 - 213 * 0.002
    assert row["p"] == int(int(45e15 * fraction) * 0.003) and row["t"] == int(row["p"] * 0.2)


def test_pool_without_blocks_takes_its_cost(spark):
    pools = spark.createDataFrame([(1, 0, 10, 5, 100, 300, 50, 0), (2, 0, 20, 5, 100, 300, 50, 3)], "pool long, pledge long, reward_addr long, margin_percent long, cost long, active_epoch long, stake long, blocks_made long")
    stats = spark.createDataFrame([(1, 300, 50, 0), (2, 300, 50, 3)], "pool long, epoch_no long, stake long, blk_cnt long")
    got = {r["pool"]: r for r in rewards.pool_rewards(pools, stats, 300).collect()}
    assert got[1]["reward"] == 0 and got[1]["operator"] == 100 and got[1]["members"] == 0 and got[1]["operator_capped"] == 0
    assert got[2]["reward"] == got[2]["operator"] + got[2]["members"] > 0


def test_no_rewards_before_the_first_epoch(spark):
    nothing = spark.createDataFrame([], "pool long, reward_addr long, operator long, members long")
    members = spark.createDataFrame([], "pool long, addr long, amount long")
    addresses = spark.createDataFrame([(1,)], "addr long")
    assert rewards.epoch_rewards(nothing, members, addresses, 210).count() == 0
    assert rewards.epoch_rewards(nothing, members, addresses, 211).count() == 1


def test_edges_merged_in_any_split_are_the_same(spark):
    rows = spark.createDataFrame([("a", "b", k, o, 10 * k + o, 5 * k) for k in range(6) for o in range(2)], "sender string, receiver string, tx_hash long, out_index long, value long, slot_no long")
    whole = wallets.incremental(rows).collect()
    for cut in (0, 7, 12, 30):
        parts = wallets.merge_edges(wallets.incremental(rows.where(F.col("slot_no") < cut)), wallets.incremental(rows.where(F.col("slot_no") >= cut)))
        assert parts.collect() == whole
    assert wallets.incremental(rows.unionByName(rows)).collect() == whole


@pytest.mark.parametrize("line, expected", [
    ("[12:00] Error 1452: x", ("Constraint", "Database", "ForeignKey")), ("Duplicate entry 'x'", None), ("Error 1062 failed", None), ("slow query 3s", ("Slow Query", "Database", "SlowQuery")),
    ("failed: connection to ChainSync", ("Processing", "ChainSync", "Sync")), ("[ERROR] block 7", ("Processing", "Block", "Process")), ("i/o timeout", ("Network", "Network", "Timeout")), ("all well", None),
])
def test_log_lines(spark, line, expected):
    row = spark.range(1).select(messages.parse_log(F.lit(line)).alias("r")).first()["r"]
    assert (tuple(row) if row else None) == expected


def test_driver_lines_are_cleaned(spark):
    row = spark.range(1).select(messages.driver_error(F.lit("[mysql] 12:34:56.789 driver.go:77 something else")).alias("r"), messages.sql_table(F.lit("INSERT INTO `txes` VALUES")).alias("t"), messages.sql_table(F.lit("update blocks set x")).alias("u")).first()
    assert row["r"]["message"] == "something else" and row["r"]["component"] == "MySQL" and row["t"] == "txes" and row["u"] == "blocks"


def test_repeated_errors_become_one(spark):
    t = datetime.datetime(2024, 1, 1)
    log = spark.createDataFrame([("k", t + datetime.timedelta(minutes=m), f"d{m}") for m in (3, 1, 2)], "kind string, ts timestamp, details string")
    row = errors.deduplicated(log, ["kind"]).first()
    assert (row["count"], row["first_seen"].minute, row["last_seen"].minute, row["last_details"]) == (3, 1, 3, "d3")


def test_queue_skips_fetched_and_exhausted(spark):
    refs = spark.createDataFrame([(k,) for k in range(6)], "id long")
    fetched = spark.createDataFrame([(0,)], "id long")
    failed = spark.createDataFrame([(1, 3), (2, 1), (2, 2), (3, 5), (3, 1)], "id long, retry_count long")
    got = offchain.unfetched(refs, fetched, failed, "id").collect()
    assert [tuple(r) for r in got] == [(2, 2), (4, 0), (5, 0)]


def test_governance_documents_and_pools(spark):
    text = '{"@context": {"@language": "en"}, "@type": "v", "authors": [{"name": "A", "witness": {"publicKey": "k"}}, {"name": "B"}], "body": {"title": "T", "references": [{"@type": "O", "label": "l", "uri": "u"}]}}'
    t = offchain.governance_documents(spark.createDataFrame([(1, text), (2, "not json"), (3, None)], "id long, j string"), "j", "id")
    assert t["documents"].where("id = 1").first()["title"] == "T" and t["documents"].where("id = 2").first()["type"] is None
    assert [(r["n"], r["name"], r["public_key"]) for r in t["authors"].orderBy("n").collect()] == [(0, "A", "k"), (1, "B", None)]
    assert tuple(t["references"].first())[2:] == ("O", "l", "u")
    pools = offchain.pool_documents(spark.createDataFrame([(1, '{"ticker": "TOOLONG", "name": "n"}')], "id long, j string"), "j", "id").first()
    assert pools["ticker"] == "TOOLO" and pools["name"] == "n" and pools["homepage"] is None


def test_rollback_log_equals_replay(spark):
    log = [("forward", 1), ("forward", 2), ("forward", 3), ("rollback", 1), ("forward", 2), ("forward", 4), ("rollback", 3), ("forward", 5), ("rollback", 2), ("forward", 3)]
    standing = []
    for seq, (kind, slot) in enumerate(log):
        standing = [x for x in standing if x[0] <= slot] if kind == "rollback" else [*standing, (slot, seq)]
    events = spark.createDataFrame([(s, k, x, str(x)) for s, (k, x) in enumerate(log)], "seq long, kind string, slot long, hash string")
    assert sorted((r["slot_no"], r["seq"]) for r in jobs.resolve_rollbacks(events).collect()) == sorted(standing)


def test_stream_of_several_batches_equals_batch(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    for k in range(3):
        spark.createDataFrame([(k * 10 + j, t + datetime.timedelta(minutes=j)) for j in range(10)], "id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def aggregate(batch):
        return batch.groupBy("ts").agg(F.count(F.lit(1)).alias("n"))

    def combine(rows):
        return rows.groupBy("ts").agg(F.sum("n").alias("n"))

    stream = jobs.replay(spark, f"{tmp_path}/in")
    part = F.pmod(F.unix_seconds("ts"), F.lit(2)).cast("int")
    got = jobs.merge_batches(stream, f"file://{tmp_path}/work", aggregate, combine, "ts timestamp, n long", part)
    assert sorted(r["n"] for r in got.collect()) == [3] * 10
    once = jobs.run(jobs.once(stream, "ts", ["ts"], "1 hour"), f"file://{tmp_path}/once")
    assert once.count() == 10
