"""Queries that replay stored events as streams and return what the streams have written."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom import folders
from chainloom.operators.selectors import Selection, select_blocks
from chainloom.plans.register import query
from chainloom.sources import blocks as nested
from chainloom.sources import ledger, ranges
from chainloom.streaming import jobs, monitor


def _events(spark, sf_dir):
    stream = jobs.replay(spark, f"{sf_dir}/events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _month(ts):
    """Parts of a state by time: about 30 days each."""
    return F.floor(F.unix_seconds(ts) / (30 * 86400)).cast("int")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS events FROM events GROUP BY 1", views=False)
def stream_hourly(spark, sf_dir):
    """Hourly counts merged batch by batch."""

    def aggregate(batch):
        return batch.groupBy(F.date_trunc("hour", "ts").alias("start")).agg(F.count(F.lit(1)).alias("events"))

    def combine(rows):
        return rows.groupBy("start").agg(F.sum("events").alias("events"))

    found = jobs.merge_batches(_events(spark, sf_dir), folders.new(spark, "hourly"), aggregate, combine, "start timestamp, events long", _month("start"))
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT event_type, user_id, count(*) AS count, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1, 2", views=False)
def stream_error_state(spark, sf_dir):
    """Signatures of errors with their counts, kept as state."""

    def aggregate(batch):
        return batch.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("count"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))

    def combine(rows):
        return rows.groupBy("event_type", "user_id").agg(F.sum("count").alias("count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))

    part = F.pmod(F.xxhash64("event_type", "user_id"), F.lit(16)).cast("int")
    found = jobs.merge_batches(_events(spark, sf_dir), folders.new(spark, "errors"), aggregate, combine, "event_type string, user_id long, count long, first_seen timestamp, last_seen timestamp", part)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query("SELECT event_id, user_id, event_type FROM events", views=False)
def stream_once(spark, sf_dir):
    """Events by id, each once, however often a batch repeats them."""
    twice = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    # stored files come in any order: the watermark waits for the whole span of the table, so that no event is late
    ts = F.col("ts").cast("timestamp")
    span = ledger.table(spark, sf_dir, "events").agg(F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts))).first()[0] or 0
    found = jobs.run(jobs.once(twice, "ts", ["event_id"], f"{span + 1} seconds"), folders.new(spark, "once"))
    return found.select("event_id", "user_id", "event_type")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 3 SECOND, ts) AS start, count(*) AS events FROM events GROUP BY 1)
SELECT start, events FROM w WHERE start + INTERVAL 3 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""", views=False)
def stream_rate_windows(spark, sf_dir):
    """Final three-second windows; those that end within ten seconds of the newest event are still open.

    Counts are merged batch by batch, so that windows of files that come late are whole.
    """

    def aggregate(batch):
        fresh = batch.groupBy(F.window("ts", "3 seconds").alias("w")).agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("last"))
        return fresh.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "last")

    def combine(rows):
        return rows.groupBy("start", "end").agg(F.sum("events").alias("events"), F.max("last").alias("last"))

    found = jobs.merge_batches(_events(spark, sf_dir), folders.new(spark, "rates"), aggregate, combine, "start timestamp, end timestamp, events long, last timestamp", _month("start"))
    newest = found.agg(F.max("last").alias("newest"))
    return found.crossJoin(F.broadcast(newest)).where("end <= newest - interval 10 seconds").select(F.col("start").cast("timestamp_ntz").alias("start"), "events")


@query("""WITH e AS (SELECT event_id AS seq, CASE WHEN event_id % 97 = 96 THEN 'rollback' ELSE 'forward' END AS kind,
  CASE WHEN event_id % 97 = 96 THEN event_id - 10 ELSE event_id END AS slot FROM events)
SELECT f.slot AS slot_no, f.seq FROM e f WHERE f.kind = 'forward' AND NOT EXISTS (SELECT 1 FROM e r WHERE r.kind = 'rollback' AND r.seq > f.seq AND r.slot < f.slot)""", views=False)
def rollback_log(spark, sf_dir):
    """Blocks that stand after a log with rollbacks of ten slots."""
    back = F.col("event_id") % 97 == 96
    events = ledger.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.when(back, "rollback").otherwise("forward").alias("kind"), F.when(back, F.col("event_id") - 10).otherwise(F.col("event_id")).alias("slot"), F.col("event_id").cast("string").alias("hash"))
    return jobs.resolve_rollbacks(events).select("slot_no", "seq")


@query("SELECT greatest(coalesce(max(slot_no), 0) - 20, 0) AS slot_no FROM blocks")
def resume_slot(spark, sf_dir):
    """Where a restart goes on: the last slot but for a margin of 20."""
    return jobs.resume_slot(ledger.blocks(spark, sf_dir))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1", views=False)
def epoch_trigger(spark, sf_dir):
    """A job for each day of a stream, run when the next day begins as those of epochs are: it counts the day's events."""
    path, where = folders.new(spark, "by-day"), folders.new(spark, "epochs")
    rows = ledger.table(spark, sf_dir, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.to_date("ts").alias("day"))
    ranges.lay_out(rows, path, "at", 4096)

    def count(blocks, day):
        return blocks.groupBy("day").agg(F.count(F.lit(1)).alias("events"))

    days = monitor.EpochJobs(where, "day date", "day", count, "day date, events long")
    stream = ranges.replay(spark, path, rows.schema, "at", max(4096, rows.count() // 6)).select("day")
    jobs.run_batches(stream, f"{where}/state", days.step)
    return days.finish(spark)


@query("SELECT slot_no, greatest(0, (SELECT max(slot_no) FROM blocks) - slot_no) AS behind, (SELECT max(slot_no) FROM blocks) - slot_no <= 86400 AS live FROM blocks")
def activation_gate(spark, sf_dir):
    """Whether live queries of the ledger's state make sense at each block: within a day of the tip."""
    rows = ledger.blocks(spark, sf_dir)
    tip = F.broadcast(rows.agg(F.max("slot_no").alias("tip")))
    slot, last = F.col("slot_no"), F.col("tip")
    return rows.crossJoin(tip).select("slot_no", monitor.slots_behind(slot, last).alias("behind"), monitor.is_near_tip(slot, last, 86400).alias("live"))


@query("""WITH b AS (SELECT o_orderkey // 64 AS block_no, o_orderkey AS k, (o_orderkey // 64) % 8 * 20000000 + (o_orderkey // 512) * 20 AS slot FROM orders),
o AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_suppkey IN (1, 2, 3))
SELECT block_no, CAST(count(*) FILTER (WHERE k IN (SELECT k FROM o) AND k % 20 = 7) AS BIGINT) AS txes FROM b WHERE slot BETWEEN 20000000 AND 120000000 GROUP BY 1""", views=False)
def selected_blocks(spark, sf_dir):
    """Selective indexing: of the blocks in a range of slots the transactions to some addresses with a metadata key."""
    chosen = Selection(addresses=["1", "2", "3"], metadata_keys=[7], first_slot=20_000_000, last_slot=120_000_000)
    return select_blocks(nested.stored(spark, sf_dir, only=("outputs", "metadata")), chosen).select("block_no", F.size("txs").cast("long").alias("txes"))
