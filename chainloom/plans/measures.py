"""Queries of what is measured in flight and without scans: footers, sessions, observed batches, sketches, selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom import folders
from chainloom.operators import matching
from chainloom.plans.register import query
from chainloom.plans.stored import _by_time
from chainloom.sources import counts, ledger
from chainloom.streaming import jobs, monitor

_COUNTED = {"customer": "c_custkey", "documents": "doc_id", "events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, min({c}) AS smallest, max({c}) AS largest FROM {t}" for t, c in _COUNTED.items()), views=False)
def stored_counts(spark, sf_dir):
    """Rows and extremes of keys of all tables from the files' footers."""
    found = counts.footer_counts(spark, {t: (f"{sf_dir}/{t}.parquet", c) for t, c in _COUNTED.items()})
    return spark.createDataFrame(found.collect(), found.schema)  # one row for each table, out of the other session


@query("""WITH e AS (SELECT event_type, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS begins FROM events),
g AS (SELECT event_type, ts, sum(begins) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM e)
SELECT event_type, min(ts) AS first, max(ts) + INTERVAL 1 HOUR AS until, count(*) AS events FROM g GROUP BY event_type, n HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""", views=False)
def stall_sessions(spark, sf_dir):
    """Spans without a stall of an hour of each kind of event, as sessions of a stream."""
    found = jobs.run_open(jobs.sessions(_by_time(spark, sf_dir, "event_type"), ["event_type"], "ts", "1 hour", "1 hour"), folders.new(spark, "sessions"))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "until")})


@query("""WITH d AS (SELECT event_id, ts, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5 AS part FROM events)
SELECT part, count(*) AS rows, min(ts) AS first, max(ts) AS tip, max(event_id) AS largest FROM d GROUP BY part""", views=False)
def observed_batches(spark, sf_dir):
    """What a listener sees of each batch of a replay, whose files hold five days each: rows, first and last time, tip."""
    where = folders.new(spark, "observed")
    part = F.floor(F.datediff("ts", F.to_date(F.lit("2024-01-01"))) / 5).cast("long")
    events = ledger.table(spark, sf_dir, "events").select("event_id", "ts", part.alias("part"))
    parts = [r[0] for r in events.select("part").distinct().orderBy("part").collect()]  # one for five days
    events.repartition("part").write.partitionBy("part").parquet(f"{where}/in")
    seen = monitor.Observed("batch")
    stream = jobs.replay(spark, f"{where}/in/part=*", 1, "event_id long, ts timestamp_ntz", f"{where}/in")
    measured = stream.observe("batch", F.min("part").cast("long").alias("part"), F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("tip"), F.max("event_id").alias("largest"))
    seen.follow(spark, measured.writeStream.format("noop").option("checkpointLocation", f"{where}/state").trigger(availableNow=True), len(parts))
    return seen.table(spark, "part long, rows long, first timestamp_ntz, tip timestamp_ntz, largest long")


@query("SELECT event_type AS key, count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events, true AS near FROM events GROUP BY 1", views=False)
def distinct_sketches(spark, sf_dir):
    """Distinct users and events of each key: exactly, and near by sketches that batches of a stream have merged."""
    events = ledger.table(spark, sf_dir, "events")
    stream = jobs.replay(spark, f"{sf_dir}/events.parquet")

    def aggregate(batch):
        return batch.groupBy(F.col("event_type").alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("user_id", 14).alias("users"), F.hll_sketch_agg("event_id", 14).alias("events"))

    def combine(rows):
        return rows.groupBy("key").agg(F.sum("rows").alias("rows"), F.hll_union_agg("users").alias("users"), F.hll_union_agg("events").alias("events"))

    part = F.pmod(F.xxhash64("key"), F.lit(8)).cast("int")
    merged = jobs.merge_batches(stream, folders.new(spark, "sketches"), aggregate, combine, "key string, rows long, users binary, events binary", part)
    exact = events.groupBy(F.col("event_type").alias("key")).agg(F.countDistinct("user_id").alias("users_exact"), F.countDistinct("event_id").alias("events_exact"))

    def near(sketch, of):
        return F.abs(F.hll_sketch_estimate(sketch) - F.col(of)) <= 0.05 * F.col(of) + 1

    found = merged.join(exact, "key")
    return found.select("key", "rows", F.col("users_exact").alias("users"), F.col("events_exact").alias("events"), (near("users", "users_exact") & near("events", "events_exact")).alias("near"))


@query("""WITH r AS (SELECT DISTINCT o_orderkey * 997 % 200000000 AS first, o_orderkey * 997 % 200000000 + o_orderkey % 50 * 4000 AS last FROM orders WHERE o_orderkey % 7 = 0 UNION SELECT 210000000, 215000000),
s AS (SELECT 'stake' AS kind, c_custkey AS value FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'pool', s_suppkey FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'script', p_partkey FROM part WHERE p_partkey % 11 = 0),
f AS (SELECT o_orderkey AS tx_hash, 'stake' AS kind, o_custkey AS value FROM orders UNION ALL SELECT l_orderkey, 'pool', l_suppkey FROM lineitem UNION ALL SELECT l_orderkey, 'script', l_partkey FROM lineitem WHERE l_linestatus = 'F'),
k AS (SELECT DISTINCT tx_hash FROM f JOIN s USING (kind, value)),
i AS (SELECT t.tx_hash FROM txes t WHERE EXISTS (SELECT 1 FROM r WHERE t.slot_no BETWEEN r.first AND r.last))
SELECT t.tx_hash, t.slot_no FROM txes t WHERE t.tx_hash IN (SELECT tx_hash FROM k) AND t.tx_hash IN (SELECT tx_hash FROM i)""")
def selected_transactions(spark, sf_dir):
    """Transactions that long lists of stake addresses, pools and scripts select within very many ranges of slots."""
    orders, lines = ledger.table(spark, sf_dir, "orders"), ledger.table(spark, sf_dir, "lineitem")
    first = F.col("o_orderkey") * 997 % 200_000_000
    ranges = orders.where("o_orderkey % 7 = 0").select(first.alias("first"), (first + F.col("o_orderkey") % 50 * 4000).alias("last"))
    ranges = ranges.unionByName(spark.range(1).select(F.lit(210_000_000).cast("long").alias("first"), F.lit(215_000_000).cast("long").alias("last")))

    def of(rows, kind, key, *more):
        return rows.select(*more, F.lit(kind).alias("kind"), F.col(key).alias("value"))

    selectors = of(ledger.table(spark, sf_dir, "customer").where("c_custkey % 3 = 0"), "stake", "c_custkey")
    selectors = selectors.unionByName(of(ledger.table(spark, sf_dir, "supplier").where("s_suppkey % 5 = 0"), "pool", "s_suppkey")).unionByName(of(ledger.table(spark, sf_dir, "part").where("p_partkey % 11 = 0"), "script", "p_partkey"))
    tx = F.col("l_orderkey").alias("tx_hash")
    facts = of(orders, "stake", "o_custkey", F.col("o_orderkey").alias("tx_hash")).unionByName(of(lines, "pool", "l_suppkey", tx)).unionByName(of(lines.where("l_linestatus = 'F'"), "script", "l_partkey", tx))
    rows = ledger.txes(spark, sf_dir).select("tx_hash", "slot_no")
    return matching.in_ranges(rows, ranges).join(matching.keyed_matches(facts, selectors), "tx_hash", "left_semi")
