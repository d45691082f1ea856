"""The filter of stored keys: results of every size are those of a plain anti-join, and few rows need a look-up."""

import pytest
from pyspark.sql import functions as F

from chainloom.operators import existence, matching, sinks


def tables(spark):
    held = spark.range(0, 4000, 2).select("id", F.concat(F.lit("k"), F.col("id") % 7).alias("name"), (F.col("id") * 3).alias("v"))
    batch = spark.range(0, 3000).select("id", F.concat(F.lit("k"), F.col("id") % 7).alias("name"), (F.col("id") * 5).alias("v"))
    batch = batch.unionByName(batch.where("id < 50").withColumn("v", F.col("v") + 1)).unionByName(spark.createDataFrame([(None, "k1", 1), (5, None, 2), (5, None, 2)], "id long, name string, v long"))
    return held, batch


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 17])
def test_every_size_gives_the_same_rows(spark, bits):
    held, batch = tables(spark)
    keys = ["id", "name"]
    existing = existence.build(held, keys, bits)
    got = existence.insert_ignore(held, batch, keys, existing, bits)
    assert sorted(map(str, got.collect())) == sorted(map(str, sinks.insert_ignore(held, batch, keys).collect()))


def test_look_ups_are_the_stored_keys_and_few_more(spark):
    held, batch = tables(spark)
    keys = ["id", "name"]
    fresh = sinks.first_of_key(batch, keys)
    stored = fresh.join(held, keys, "left_semi").count()
    looked_up = {}
    for bits in (64, 1 << 13, existence.bits_for(held.count()), 1 << 20):
        rows = existence.marked(fresh, existence.build(held, keys, bits), keys, bits)
        assert rows.count() == fresh.count()
        looked_up[bits] = rows.where("maybe").count()
    new = fresh.count() - stored
    assert looked_up[64] == fresh.count()
    assert stored <= looked_up[existence.bits_for(held.count())] <= stored + 0.05 * new
    assert looked_up[1 << 20] == stored


def test_filters_of_batches_merge(spark):
    held, _ = tables(spark)
    keys, bits = ["id", "name"], 1 << 14
    halves = [existence.build(held.where(c), keys, bits) for c in ("id < 2000", "id >= 2000")]
    assert sorted(map(str, existence.merge(*halves).collect())) == sorted(map(str, existence.build(held, keys, bits).collect()))
    assert existence.marked(held, existence.build(held.limit(0), keys, bits), keys, bits).where("maybe").count() == 0


def test_slots_in_ranges_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    ranges = [(a, a + rng.choice([-1, 0, 3, 50, 3000, 90_000])) for a in (rng.randrange(1_000_000) for _ in range(60))] + [(None, 5), (7, None), (3, 3), (3, 3)]
    slots = [rng.randrange(-10, 1_100_000) for _ in range(3000)] + [None, 3, 3]
    rows = spark.createDataFrame([(s, k) for k, s in enumerate(slots)], "slot_no long, k long")
    expected = sorted(k for k, s in enumerate(slots) if s is not None and any(a is not None and b is not None and a <= s <= b for a, b in ranges))
    frame = spark.createDataFrame(ranges, "first long, last long")
    for width, wide in ((1 << 12, 1 << 10), (16, 4), (1 << 20, 2)):
        found = matching.in_ranges(rows, frame, width=width, wide=wide)
        assert sorted(r["k"] for r in found.collect()) == expected
    assert found.columns == rows.columns


def test_many_selectors_and_ranges_make_no_nested_loop(spark):
    rows = spark.range(50_000).select(F.col("id").alias("tx_hash"), (F.col("id") * 37).alias("slot_no"))
    ranges = spark.range(100_000).select((F.col("id") * 20).alias("first"), (F.col("id") * 20 + 5).alias("last"))
    facts = rows.select("tx_hash", F.lit("stake").alias("kind"), F.col("tx_hash").alias("value"))
    selectors = spark.range(0, 200_000, 2).select(F.lit("stake").alias("kind"), F.col("id").alias("value"))
    found = matching.in_ranges(rows, ranges).join(matching.keyed_matches(facts, selectors), "tx_hash", "left_semi")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.count() == sum(1 for k in range(0, 50_000, 2) if k * 37 % 20 <= 5 and k * 37 < 2_000_000)


def test_a_key_needs_one_page_and_the_batch_one_exchange(spark):
    """The bits of a key lie in one page; neither building nor looking up gathers rows by key again."""
    held, batch = tables(spark)
    keys, bits = ["id", "name"], 1 << 20
    one = existence.build(held.where("id = 4"), keys, bits)
    assert one.count() == 1 and one.select(F.bitmap_count("bits")).first()[0] <= existence.HASHES
    existing = existence.build(held, keys, bits)
    plan = existence.marked(batch, existing, keys, bits)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan
    assert existing.count() > 20
