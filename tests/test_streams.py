"""Replays of a table of several files, whose order is not the events' own."""

import datetime
import os

from pyspark.sql import functions as F

from chainloom import folders
from chainloom.operators import errors
from chainloom.plans import registry
from chainloom.streaming import jobs

FIRST = datetime.datetime(2024, 1, 1)


def events(spark, tmp_path):
    """960 events of 30 days, two in 90 minutes, in 6 files each of which spans all days."""
    rows = [(2 * k + j, k % 7, "view", FIRST + datetime.timedelta(minutes=90 * k, seconds=j)) for k in range(480) for j in range(2)]
    where = f"{tmp_path}/events.parquet"
    os.makedirs(where)
    for n, part in enumerate((5, 2, 4, 0, 3, 1)):
        some = [r for r in rows if r[0] % 6 == part]
        one = f"{tmp_path}/one-{n}"
        spark.createDataFrame(sorted(some, reverse=True), "event_id long, user_id long, event_type string, ts timestamp_ntz").coalesce(1).write.parquet(one)
        file = next(f for f in os.listdir(one) if f.endswith(".parquet"))
        os.rename(f"{one}/{file}", f"{where}/{n}.parquet")
        os.utime(f"{where}/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    return rows


def test_no_event_is_late_in_a_replay_of_many_files(spark, tmp_path):
    rows = events(spark, tmp_path)
    got = registry.QUERIES["stream_once"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(r[:3] for r in rows)


def test_windows_cut_by_files_are_whole(spark, tmp_path):
    rows = events(spark, tmp_path)
    got = registry.QUERIES["stream_rate_windows"](spark, str(tmp_path)).collect()
    # the newest window is still open
    assert sorted((r["start"], r["events"]) for r in got) == [(r[3], 2) for r in rows[:-2:2]]


def test_state_is_found_again_and_only_touched_parts_are_rewritten(spark, tmp_path):
    where, out = f"{tmp_path}/state", f"{tmp_path}/in"

    def total(k, rows):
        spark.createDataFrame(rows, "k int, n long").coalesce(1).write.mode("append").parquet(out)
        return again()

    def again():
        stream = jobs.replay(spark, out, 10)
        found = jobs.merge_batches(stream, where, lambda b: b.groupBy("k").agg(F.sum("n").alias("n")), lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), "k int, n long", F.col("k") % 4)
        return sorted(map(tuple, found.collect()))

    assert total(0, [(1, 1), (2, 2), (3, 3)]) == [(1, 1), (2, 2), (3, 3)]
    assert again() == [(1, 1), (2, 2), (3, 3)]  # no new batch
    assert total(1, [(2, 5), (6, 1)]) == [(1, 1), (2, 7), (3, 3), (6, 1)]
    assert [p for p in folders.names(spark, f"{where}/v1") if p.startswith("part__")] == ["part__=2"]
    assert total(2, [(1, 1)]) == [(1, 2), (2, 7), (3, 3), (6, 1)]


def test_eviction_is_exact_among_equal_times(spark):
    same = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(k, same) for k in range(95)] + [(95 + k, same - datetime.timedelta(days=1)) for k in range(5)], "id long, ts timestamp")
    kept = sorted(r["id"] for r in errors.evict_oldest(rows.repartition(5), "ts", "id").collect())
    assert kept == list(range(5, 95))  # the five older ones, and of the equal ones the five smallest keys
    assert errors.evict_oldest(rows.limit(3), "ts", "id").count() == 2 and errors.evict_oldest(rows.limit(0), "ts", "id").count() == 0


def test_gaps_across_days(spark):
    times = [datetime.datetime(2024, 1, 1, 23), datetime.datetime(2024, 1, 2, 0, 30), datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 5, 3)]
    got = errors.gaps(spark.createDataFrame([("a", t) for t in times] + [("b", times[0])], "key string, ts timestamp"), "ts", "key", 3600).collect()
    assert sorted((r["gap_start"], r["gap_end"]) for r in got) == [(times[0], times[1]), (times[1], times[2]), (times[3], times[4])]
