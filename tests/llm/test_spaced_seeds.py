import itertools
import random
import time

import numpy as np
import pytest

from chainloom.llm import spaced_seeds as ss


def brute(items, docs):
    """Document, item and the best overlap by comparing every diagonal, without seeds: through each equal word the
    stretch of the highest score, the shortest one of equals."""
    found = {}
    for i, item in items:
        a = (item or "").lower().split()
        for d, doc in docs:
            b = (doc or "").lower().split()
            for shift in range(-len(a) + 1, len(b)):
                low, high = max(0, -shift), min(len(a), len(b) - shift)
                same = [a[k] == b[shift + k] for k in range(low, high)]
                if sum(same) < min(ss.LEAST_EQUAL, -(-len(a) * 9 // 10)):
                    continue
                score = np.concatenate([[0], np.cumsum([1 if x else -2 for x in same])])
                for w in (k for k, x in enumerate(same) if x):
                    x = max(range(w + 1), key=lambda k: (-score[k], k))
                    y = max(range(w + 1, len(same) + 1), key=lambda k: (score[k], -k))
                    equal = sum(same[x:y])
                    if ss.passes(y - x, equal, len(a)):
                        own = (-equal, low + shift + x, low + shift + y)
                        found[d, i] = min(found.get((d, i), own), own)
    return {(d, i, x, y - 1, -n) for (d, i), (n, x, y) in found.items()}


def make():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([8, 15, 30, 50])))) for k in range(30)]
    docs = []
    for d in range(120):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 300))]
        if d % 3 == 0:
            passage = items[d % 30][1].split()
            for _ in range(len(passage) // 15):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() if rng.random() < 0.2 else w for w in passage]
        docs.append((d, "  ".join(body)))
    return items, docs


def test_planted_overlaps_are_found_and_others_left_alone(spark):
    items, docs = make()
    rows = ss.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    planted = {(d, d % 30) for d in range(0, 120, 3)}
    exact = {(d, i) for d, i in planted if len(items[i][1].split()) < 15}
    assert {tuple(r)[:5] for r in rows} == brute(items, docs) and len(rows) == len(got)
    assert exact <= got and {d for d, _ in got} <= {d for d, _ in planted}


def test_blocks_do_not_change_the_result(spark):
    items, docs = make()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(ss.find_overlaps(d, b).collect()) == sorted(ss.find_overlaps(d, b, block_words=100).collect())
    kept = ss.drop_contaminated(d, b, block_words=100)
    hit = {r["doc_id"] for r in ss.find_overlaps(d, b).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {x for x, _ in docs} - hit


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, item, 0), (1, item, 0), (None, item, 0), (2, None, 0), (3, "", 0), (4, "x " * 50000 + item, 0), (5, "one two", 0)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (8, None), (None, item), (9, "one two")], "item_id long, text string")
    got = ss.find_overlaps(docs, bench).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in got) == [("1", 7), ("1", 7), ("1", 9), ("1", 9), ("4", 7), ("4", 9), ("5", 9), ("None", 7), ("None", 9)]
    kept = ss.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    kept = ss.drop_contaminated(docs, bench.where("item_id = 7"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    assert ss.find_overlaps(docs.limit(0), bench).count() == 0 and ss.find_overlaps(docs, bench.limit(0)).count() == 0
    assert ss.drop_contaminated(docs, bench.limit(0)).count() == 7


def accepted(n):
    """Every choice of substituted words of an item of ``n`` words that ``passes`` accepts, for some stretch."""
    for k in range(n // 3 + 1):
        for places in itertools.combinations(range(n), k):
            doc = np.arange(n, dtype=np.uint64)
            doc[list(places)] += 1000
            if any(ss.passes(stop - start, equal, n) for start, stop, equal in ss.overlaps(np.arange(n, dtype=np.uint64), doc, 0)):
                yield doc


def test_short_items_equal_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items, docs = [(f"item {n} {k}", text(n)) for n in range(1, 9) for k in range(4)], [(d, text(rng.randrange(60))) for d in range(60)]
    got = ss.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert {tuple(r)[:5] for r in got} == brute(items, docs) and len(got) > 60


def test_a_phrase_that_many_items_share_is_quick():
    rng = np.random.default_rng(0)
    phrase = ss.words.mix(np.arange(12, dtype=np.uint64))
    items = [(k, np.concatenate([rng.integers(1 << 60, size=20).astype(np.uint64), phrase, rng.integers(1 << 60, size=20).astype(np.uint64)])) for k in range(300)]
    block, doc = ss.Block(items), np.tile(phrase, 267)
    began = time.process_time()
    assert ss.matches(block, doc) == {}
    assert time.process_time() - began < 2.0


def test_one_block_is_broadcast_at_a_time(spark):
    items, docs = make()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    alive, most, made = set(), [], spark.sparkContext.broadcast

    def broadcast(value):
        shared = made(value)
        destroy = shared.destroy
        alive.add(id(shared))
        most.append(len(alive))
        shared.destroy = lambda: (alive.discard(id(shared)), destroy())
        return shared

    spark.sparkContext.broadcast = broadcast
    try:
        hits = {r["doc_id"] for r in ss.find_overlaps(d, b, block_words=80).collect()}
        assert len(most) >= 10 and max(most) == 1 and len(alive) == 0
        assert {r["doc_id"] for r in ss.drop_contaminated(d, b, block_words=80).collect()} == {x for x, _ in docs} - hits and max(most) == 1
    finally:
        del spark.sparkContext.broadcast


@pytest.mark.parametrize("n", range(6, 18))
def test_every_accepted_pattern_is_found(n):
    step = ss.words.mix(np.arange(n, dtype=np.uint64))
    block = ss.Block([(1, step)])
    for doc in accepted(n):
        assert 0 in ss.matches(block, ss.words.mix(doc)), doc


def test_masks_hit_long_stretches_too():
    """The fewest substitutions that keep a stretch of so many words from all masks are more than ``passes`` allows."""
    span = max(map(len, ss.MASKS))
    state, full = np.arange(1 << span), (1 << span) - 1
    cost = np.full(1 << span, 10**6)
    cost[0] = 0
    for length in range(1, 61):
        following = np.full(1 << span, 10**6)
        for equal in (0, 1):
            np.minimum.at(following, (state << 1 | equal) & full, cost + 1 - equal)
        for mask in ss.MASKS:
            pattern = int(mask, 2)
            following[(state & pattern) == pattern] = 10**6
        cost = following
        for item in {length, 60}:
            most = max((k for k in range(length) if item >= ss.SHORT_ITEM and ss.passes(length, length - k, item)), default=-1)
            assert cost.min() > most


def test_an_item_without_an_id_contaminates_too(spark):
    item = " ".join(f"item{k}" for k in range(20))
    docs = spark.createDataFrame([(1, item), (2, "clean words of a document"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (None, None)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in ss.drop_contaminated(docs, bench).collect()) == [2, 3]
