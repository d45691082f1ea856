"""The source of slots, aggregates with rollbacks, keyed state and bucketed joins."""

import datetime
import os
import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from chainloom import folders
from chainloom.operators import utxo, wallets
from chainloom.plans import registry
from chainloom.sources import layout, ledger, ranges
from chainloom.streaming import keyed, retract
from chainloom.streaming.retract import Retracting

DATA = "/root/testdata/sf0.001"
FIRST = datetime.datetime(2024, 1, 1)


def collected(stream, where, limit=None):
    """The rows of each batch of a stream."""
    batches = []

    def keep(batch, number):
        batches.append(sorted(map(tuple, batch.collect())))

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", where).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [b for b in batches if b]


def store(spark, path, slots, mode="append"):
    rows = spark.createDataFrame([(s, f"b{s}", [(s, "x")]) for s in slots], "slot long, name string, txs array<struct<n:long,t:string>>")
    rows.sortWithinPartitions("slot").coalesce(1).write.mode(mode).option("parquet.block.row.count.limit", 5).parquet(path)


def test_slots_come_in_order_in_bounded_batches(spark, tmp_path):
    slots = sorted(random.Random(1).sample(range(1000), 60))
    path = f"file://{tmp_path}/in"
    store(spark, path, slots[:40])
    store(spark, path, slots[40:])
    got = collected(ranges.replay(spark, path, "slot long, name string", rows=10), f"{tmp_path}/c1")
    assert [r[0] for b in got for r in b] == slots
    assert len(got) >= 4 and all(len(b) <= 15 for b in got)
    inside = collected(ranges.replay(spark, path, "slot long", rows=10, start=slots[7], before=slots[33]), f"{tmp_path}/c2")
    assert [r[0] for b in inside for r in b] == slots[7:33]
    nested = collected(ranges.replay(spark, path, "slot long, txs array<struct<t:string>>", rows=1000), f"{tmp_path}/c3")
    assert [(r[0], r[1][0].t) for b in nested for r in b] == [(s, "x") for s in slots]


def test_a_restart_goes_on_where_the_checkpoint_stands(spark, tmp_path):
    path, where = f"file://{tmp_path}/in", f"file://{tmp_path}/c"
    store(spark, path, range(0, 30))
    first = collected(ranges.replay(spark, path, "slot long", rows=10), where)
    assert ranges.reached(spark, where) == 30
    store(spark, path, range(30, 70))
    again = collected(ranges.replay(spark, path, "slot long", rows=10, checkpoint=where), where)
    assert [r[0] for b in first + again for r in b] == list(range(70))
    assert len(again) >= 3 and all(len(b) <= 15 for b in again)


def test_layout_holds_ranges(spark, tmp_path):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(100000)).alias("slot"))
    ranges.lay_out(rows, f"file://{tmp_path}/l", group_rows=100)
    reader = ranges.SlotReader(rows.schema, {"path": f"file://{tmp_path}/l"})
    groups = reader.groups()
    assert len(groups) >= 40
    assert all(a[1] <= b[0] + 1 for a, b in zip(groups, groups[1:], strict=False))


def log_of(seed, n):
    """A chain of blocks of some edges with rollbacks, of which blocks may come again."""
    rng, out, slot = random.Random(seed), [], 0
    for seq in range(n):
        if rng.random() < 0.12 and slot > 3:
            slot = max(0, slot - rng.choice([1, 2, 5, 30]))
            out.append([(seq, "rollback", slot, None, None, None)])
        else:
            slot += rng.randrange(1, 4)
            out.append([(seq, "forward", slot, rng.randrange(4), rng.choice(["x", "y", None]), rng.randrange(100)) for _ in range(rng.randrange(1, 4))])
    return out


def standing_edges(blocks):
    chain = []
    for rows in blocks:
        chain = [b for b in chain if b[0][2] <= rows[0][2]] if rows[0][1] == "rollback" else [*chain, rows]
    found = defaultdict(list)
    for rows in chain:
        for _, _, slot, a, b, amount in rows:
            found[a, b].append((slot, amount))
    return sorted(((a, b, len(v), sum(x for _, x in v), min(v)[0], max(v)[0]) for (a, b), v in found.items()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_rollbacks_subtract_what_they_undo(spark, tmp_path, seed):
    blocks = log_of(seed, 60)
    schema = "seq long, kind string, slot long, a long, b string, amount long"
    path, where = f"file://{tmp_path}/log", f"file://{tmp_path}/state"
    state = Retracting(where, "a long, b string", 8, 3)
    for k in range(0, 60, 20):  # three runs of several batches, each a restart
        rows = [r for b in blocks[k : k + 20] for r in b]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("parquet.block.row.count.limit", 4).parquet(path)
        found = state.run(ranges.replay(spark, path, schema, "seq", rows=12, checkpoint=f"{where}/checkpoint"))
        assert sorted(map(tuple, found.collect()), key=str) == standing_edges(blocks[: k + 20])


def test_a_rollback_rewrites_spans_beyond_it_only(spark, tmp_path):
    where = f"file://{tmp_path}/state"
    state = Retracting(where, "a long", 10, 2)
    schema = "seq long, kind string, slot long, a long, amount long"
    state.step(spark.createDataFrame([(s, "forward", s, s % 3, 1) for s in range(60)], schema), 0)
    state.step(spark.createDataFrame([(100, "rollback", 44, None, None)], schema), 1)
    assert sorted(folders.names(spark, f"{where}/slots/v1")) == ["_SUCCESS", "part__=4", "part__=5"]
    assert sum(r["n"] for r in state.table(spark).collect()) == 45
    state.step(spark.createDataFrame([(100, "rollback", 44, None, None)], schema), 1)  # the batch again
    assert sorted(map(tuple, state.table(spark).collect())) == [(k, 15, 15, k, 42 + k) for k in range(3)]


def test_rows_of_a_batch_go_through_no_window(spark, tmp_path, monkeypatch):
    seen, standing = [], retract.jobs.standing
    monkeypatch.setattr(retract.jobs, "standing", lambda events: seen.append((events.columns, events.count())) or standing(events))
    monkeypatch.setattr(retract, "BROADCAST_ROWS", 0)  # blocks and keys are joined by a shuffle, with the same result
    state = Retracting(f"file://{tmp_path}/state", "a long", 10, 2)
    schema = "seq long, kind string, slot long, a long, amount long"
    state.step(spark.createDataFrame([(s, "forward", s, k, 1) for s in range(20) for k in range(50)], schema), 0)
    state.step(spark.createDataFrame([(20, "rollback", 14, None, None), *((21, "forward", 16, k, 2) for k in range(25))], schema), 1)
    assert seen == [(["seq", "kind", "slot"], 20), (["seq", "kind", "slot"], 2)]
    assert sorted(map(tuple, state.table(spark).collect())) == [(k, 16, 17, 0, 16) if k < 25 else (k, 15, 15, 0, 14) for k in range(50)]


def test_a_slot_that_comes_again_counts_once(spark, tmp_path):
    state = Retracting(f"file://{tmp_path}/state", "a long", 10, 2)
    schema = "seq long, kind string, slot long, a long, amount long"
    state.step(spark.createDataFrame([(s, "forward", s, 1, 5) for s in range(30)], schema), 0)
    state.step(spark.createDataFrame([(s, "forward", s, 1, 5) for s in range(25, 40)], schema), 1)
    assert [tuple(r) for r in state.table(spark).collect()] == [(1, 40, 200, 0, 39)]


def minutes(n):
    return FIRST + datetime.timedelta(minutes=n)


def by_time(spark, tmp_path, rows, schema):
    path = f"file://{tmp_path}/by-time"
    frame = spark.createDataFrame(rows, schema).withColumn("at", F.unix_micros("ts"))
    frame.sort("at").coalesce(1).write.option("parquet.block.row.count.limit", 6).parquet(path)
    return ranges.replay(spark, path, frame.schema, "at", rows=6)


def test_episodes_end_and_their_state_goes(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted((minutes(rng.randrange(3000)), rng.choice("ab")) for _ in range(60)) + [(minutes(9000), "c")]
    stream = by_time(spark, tmp_path, rows, "ts timestamp, key string")
    quiet = datetime.timedelta(minutes=90)
    found = keyed.run(keyed.episodes(stream, ["key"], "ts", quiet, "5 minutes"), f"file://{tmp_path}/out").collect()
    expected = []
    for key in "ab":
        own, current = [t for t, k in rows if k == key], []
        for t in own:
            if current and t - current[-1] > quiet:
                expected.append((key, len(current), current[0], current[-1]))
                current = []
            current.append(t)
        expected.append((key, len(current), current[0], current[-1]))  # the watermark is far beyond
    assert sorted(map(tuple, found)) == sorted(expected)
    held = spark.read.format("statestore").option("stateVarName", "open").load(f"file://{tmp_path}/out/state").select("key.*").collect()
    assert [tuple(r) for r in held] == [("c",)]


def test_retries_fall_due_unless_something_works_before(spark, tmp_path):
    rng = random.Random(5)
    rows = sorted((minutes(k * 7 + rng.randrange(5)), rng.choice("ab"), rng.random() < 0.7) for k in range(80)) + [(minutes(9000), "c", False)]
    stream = by_time(spark, tmp_path, rows, "ts timestamp, key string, failed boolean")
    step = datetime.timedelta(minutes=6)
    found = keyed.run(keyed.retries(stream, ["key"], "ts", "failed", step, 3, "5 minutes"), f"file://{tmp_path}/out").collect()
    expected = []
    for key in "ab":
        own, failures = [(t, f) for t, k, f in rows if k == key], 0
        for (t, failed), after in zip(own, [*own[1:], (None, None)], strict=True):
            failures = failures + 1 if failed else 0
            if 0 < failures <= 3 and (after[0] is None or t + step * failures <= after[0]):
                expected.append((key, failures, t + step * failures))
    assert sorted(map(tuple, found)) == sorted(expected)


def exchanges(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range|single)\w*\(?([^,)]*)", plan)


@pytest.fixture(scope="module")
def tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield layout.bucketed(spark, DATA)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
class TestBuckets:
    def test_unspent_outputs_shuffle_nothing(self, spark, tables):
        found = layout.unspent(tables["tx_outs"], tables["tx_ins"])
        assert exchanges(found) == []
        plain = utxo.unspent(ledger.tx_outs(spark, DATA), ledger.tx_ins(spark, DATA))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))

    def test_transfers_shuffle_inputs_only(self, spark, tables):
        found = layout.transfers(tables["tx_ins"], tables["tx_outs"], tables["txes"])
        assert len(exchanges(found)) == 1 and "tx_hash" in exchanges(found)[0]
        plain = wallets.transfers(ledger.tx_ins(spark, DATA), ledger.tx_outs(spark, DATA), ledger.txes(spark, DATA))
        columns = ["sender", "receiver", "tx_hash", "out_index", "value", "slot_no"]
        assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))

    def test_rollback_shuffles_inputs_only(self, spark, tables):
        found = layout.standing_after(tables, 180_000_000)
        assert exchanges(found["txes"]) == [] and exchanges(found["tx_outs"]) == []
        assert len(exchanges(found["tx_ins"])) == 1

    def test_each_bucket_is_one_file(self, spark, tables):
        for frame in tables.values():
            names = [f.rpartition("/")[2] for f in frame.inputFiles()]
            buckets = [re.search(r"_(\d{5})\.", n)[1] for n in names]
            assert len(buckets) == len(set(buckets))


def test_new_files_under_the_same_path_are_seen(spark, tmp_path):
    where = f"{tmp_path}/data"
    os.makedirs(where)
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{DATA}/{name}.parquet").where(("o" if name == "orders" else "l") + "_orderkey < 200").write.parquet(f"{where}/{name}.parquet")
    before = registry.QUERIES["slot_stream"](spark, where).agg(F.sum("txes")).first()[0]
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{DATA}/{name}.parquet").where(("o" if name == "orders" else "l") + "_orderkey between 200 and 400").write.mode("append").parquet(f"{where}/{name}.parquet")
    after = registry.QUERIES["slot_stream"](spark, where).agg(F.sum("txes")).first()[0]
    assert after > before


def test_episodes_of_the_query_take_no_call_for_each_key(spark, monkeypatch):
    """Few batches with many keys: the state of episodes is Spark's own, and retries get rows, not a frame for each key."""
    plans = []
    original = keyed.run
    monkeypatch.setattr(keyed, "run", lambda stream, where: (plans.append(stream._jdf.queryExecution().analyzed().toString()), original(stream, where))[1])
    for name in ("error_episodes", "retries_due"):
        registry.QUERIES[name](spark, DATA)
    assert "session_window" in plans[0] and "TransformWithState" not in plans[0]
    assert "Pandas" not in plans[1]


def test_episodes_that_the_watermark_cannot_tell_have_ended(spark, tmp_path):
    """Ended by a later event within the last hours, within a millisecond of the last event, and by events without a time."""
    end = datetime.datetime(2024, 1, 3, 0, 0, 0, 700)
    ago = lambda hours, micros=0: end - datetime.timedelta(hours=hours, microseconds=micros)
    rows = [(1, ago(12.5)), (1, ago(0.2)), (2, ago(12.5)), (2, ago(0.6)), (3, ago(13)), (4, ago(13, -300)), (5, ago(13, 300)), (6, ago(40)), (7, end), (8, ago(13, 699)), (9, ago(3)), (9, None), (9, None)]
    rows += [(None, ago(30)), (None, ago(12.5)), (None, ago(0.2)), (None, None), (None, None)]
    events = spark.createDataFrame([(t, u, "error") for u, t in rows], "ts timestamp_ntz, user_id long, event_type string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    expected = duck.sql(registry.ORACLES["error_episodes"]).fetchall()
    assert len(expected) == 8
    found = registry.QUERIES["error_episodes"](spark, str(tmp_path)).select("event_type", "user_id", "count", "first", "last").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_no_events_have_no_episodes(spark, tmp_path):
    spark.createDataFrame([], "ts timestamp_ntz, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    assert registry.QUERIES["error_episodes"](spark, str(tmp_path)).collect() == []
