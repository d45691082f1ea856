import random
import zlib
from collections import Counter, defaultdict

import pytest

from chainloom.llm.sharding import Segments, assign_shards, even_cuts


def minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > middle:
                used, at = used + 1, 0
            at += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed", range(6))
def test_cuts_reach_the_smallest_capacity(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 40, 300 if seed % 2 else 2]) for _ in range(rng.randrange(3, 200))]
    seg = Segments([(k, 16, s, 1) for k, s in enumerate(sizes)])
    cuts = [0, *even_cuts(seg, 16)]
    widths = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    assert len(widths) == 16 and min(widths) >= 0 and max(widths) == minimax(sizes, 16)


@pytest.mark.parametrize("hot", [False, True])
def test_rows(spark, hot):
    rng = random.Random(9)
    texts = [None, "", *("t" * rng.randrange(1, 400) + str(k % 180) for k in range(900))]
    if hot:
        texts += ["the same text " * 30] * 500
    rows = [*enumerate(texts), (3, texts[3]), (None, "x")]
    got = assign_shards(spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, shard int").repartition(5)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots, text_of, shards_of, load = defaultdict(list), dict(enumerate(texts)), defaultdict(set), Counter()
    for r in got:
        assert 0 <= r["shard"] <= 15 and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        if r["doc_id"] is not None:
            shards_of[text_of[r["doc_id"]] or ""].add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in shards_of.values())
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(load.values()) <= max(max(groups.values()), sum(groups.values()) / 16 * 1.1)


def test_empty_and_few(spark):
    schema = "doc_id long, text string"
    assert assign_shards(spark.createDataFrame([], schema)).count() == 0
    assert [(r["size"], r["slot"]) for r in assign_shards(spark.createDataFrame([(1, "ab")], schema)).collect()] == [(3, 0)]
