"""Footers, merged sketches and observed batches."""

import datetime

import pytest
from pyspark.sql import functions as F

from chainloom.sources import counts
from chainloom.streaming import jobs, monitor


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(5, 1005).repartition(3).write.parquet(f"{tmp_path}/a")
    spark.range(0).write.parquet(f"{tmp_path}/b")
    found = counts.footer_counts(spark, {"a": (f"{tmp_path}/a", "id"), "b": (f"{tmp_path}/b", "id")})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*), MIN(id), MAX(id)]") == 2 or plan.count("PushedAggregation") >= 1
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 1000, 5, 1004), ("b", 0, None, None)]
    one = counts.footer_session(spark).read.parquet(f"{tmp_path}/a").agg(F.count(F.lit(1)))
    scan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "id#" not in scan.split("RelationV2")[-1]  # no column is read
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # other sessions are left alone


def test_sketches_of_batches_merge_with_a_small_error(spark, tmp_path):
    for k in range(4):
        spark.range(k * 10_000, k * 10_000 + 20_000).select((F.col("id") % 3).alias("key"), F.col("id").alias("user")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def aggregate(batch):
        return batch.groupBy("key").agg(F.hll_sketch_agg("user", 14).alias("users"))

    def combine(rows):
        return rows.groupBy("key").agg(F.hll_union_agg("users").alias("users"))

    stream = jobs.replay(spark, f"{tmp_path}/in")
    merged = jobs.merge_batches(stream, f"file://{tmp_path}/work", aggregate, combine, "key long, users binary", F.col("key").cast("int"))
    got = {r["key"]: r["n"] for r in merged.select("key", F.hll_sketch_estimate("users").alias("n")).collect()}
    for key, n in got.items():
        exact = len(range(key, 50_000, 3))
        print("relative error of a sketch:", abs(n - exact) / exact)
        assert abs(n - exact) <= 0.03 * exact
    assert len(got) == 3


def test_sessions_end_at_a_gap(spark, tmp_path):
    first = datetime.datetime(2024, 1, 1)
    minutes = [0, 5, 14, 30, 31, 200, 400]
    for k in (0, 1):
        rows = [("a", first + datetime.timedelta(minutes=m)) for m in minutes[k * 4 : k * 4 + 4]]
        spark.createDataFrame(rows, "key string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    found = jobs.run_open(jobs.sessions(jobs.replay(spark, f"{tmp_path}/in"), ["key"], "ts", "10 minutes", "1 minute"), f"file://{tmp_path}/out")
    at = {m: first + datetime.timedelta(minutes=m) for m in (0, 24, 30, 41, 200, 210)}
    assert sorted(map(tuple, found.collect())) == [("a", at[0], at[24], 3), ("a", at[30], at[41], 2), ("a", at[200], at[210], 1)]


def test_observed_batches_are_waited_for(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    counts.footer_session(spark)  # another session does not matter

    def follow(batches, name):
        seen = monitor.Observed("m")
        stream = jobs.replay(spark, f"{tmp_path}/in").observe("m", F.count(F.lit(1)).alias("rows"), F.max("id").alias("tip"))
        seen.follow(spark, stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True), batches, patience=3.0)
        return seen.table(spark, "rows long, tip long")

    assert sorted(map(tuple, follow(3, "a").collect())) == [(10, 9), (10, 19), (10, 29)]
    with pytest.raises(TimeoutError):
        follow(4, "b")
