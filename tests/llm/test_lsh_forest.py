import math
import random
import struct
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainloom.llm import lsh_forest
from chainloom.llm.components import Forest, components
from chainloom.llm.lsh_forest import clashes, describe, mixed, near_duplicates, neighbours, one_of_each, rename


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] * bool(words))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return Counter((d, len(sets[i]), d if not sets[i] else least.get(find(i))) for i, (d, _) in enumerate(rows))


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    texts = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.45:
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 40, 150, 400]))]
            if kind > 0.8:
                words[:0] = passage
            texts.append("\t".join(w.upper() if rng.random() < 0.05 else w for w in words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = [*enumerate(corpus(seed, 400), 10), (1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "a b c")]
    rows += [rows[5], (900, rows[6][1]), (None, "only null has this text here now"), (1000, "z " * 30000)]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, node string").repartition(3)
    got = near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["component_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_one_row_of_each_group_stays(spark):
    rows = [*enumerate(corpus(4, 150), 10), (1, None), (2, "")]
    docs = spark.createDataFrame([(a, b, "en") for a, b in [*rows, rows[3]]], "doc_id long, text string, lang string")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {c for (_, _, c) in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    other = spark.createDataFrame([(5, "one two three four five six"), (5, "another text of quite other words"), (5, "one two three four five six"), (7, "one two three four five six"), (None, "one two three four five six"), (None, "x y"), (None, "x y"), (9, None), (9, None)], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("mark0", "d__", "kept", "node")})
    got = one_of_each(other)
    assert got.columns == other.columns and sorted((str(r["doc_id"]), str(r["text"])[:3]) for r in got.collect()) == [("5", "ano"), ("5", "one"), ("9", "Non"), ("None", "x y")]
    assert one_of_each(docs.limit(0)).count() == 0 and near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most,rows", [(10**6, 10**5), (10**6, 50), (0, 50)])
def test_long_chain(spark, monkeypatch, most, rows):
    monkeypatch.setattr("chainloom.llm.components.BROADCAST_NODES", most)
    monkeypatch.setattr("chainloom.llm.components.ALONE", rows - 100)
    monkeypatch.setattr("chainloom.llm.scratch.SMALL_ROWS", rows)  # many tasks, so that stars of several forests meet
    edges = spark.createDataFrame([(k, k + 1) for k in range(500)] + [(1000, 1001), (5, 5)], "a long, b long").repartition(8)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(501)}, 1000: 1000, 1001: 1000}


def test_cuts_between_ranges_part_no_neighbours(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "RANGE_ROWS", 256)
    base = " ".join(f"w{k}" for k in range(300))
    rows = [(k, base.replace(f"w{7 * k + 3} ", f"x{k} ")) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = describe(docs).where("node is not null").selectExpr("node", "doc_id as least", "signature", "sketch")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for parts in ("1", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            pairs = neighbours(nodes).collect()
            forest = Forest()
            for r in pairs:
                forest.join(r["a"], r["b"])
            found.append({forest.root(x) for r in pairs for x in (r["a"], r["b"])})
        assert found[0] == found[1] and len(found[0]) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def near(different):
    """Candidates among nodes 0, 1, 2 of one run, of which the first ``different[k]`` sketch values are changed."""
    signature = np.full((len(different), lsh_forest.HASHES), 1, dtype=np.uint16)
    for k, n in enumerate(different):
        signature[k, :n] = 2
    packed = lsh_forest.sketches(signature)
    key = np.ones(lsh_forest.DEPTH, dtype=">u2").tobytes()
    n = len(different)
    rows = pa.RecordBatch.from_arrays([pa.array([0] * n, type=pa.int8()), pa.array([key] * n), pa.array(range(n), type=pa.int64()), pa.array(range(n), type=pa.int64()), pa.array([p.tobytes() for p in packed])], names=["tree", "key", "node", "root", "sketch"])
    low, high, _ = lsh_forest._near(rows, 4)
    return sorted(set(zip(low.tolist(), high.tolist(), strict=True)))


def test_candidates_that_close_a_circle_wait_for_exact_checks():
    # all three are sure by their sketches, but none is confirmed yet
    assert near([0, 3, 6]) == [(0, 1), (0, 2), (1, 2)]


def test_no_true_link_is_lost_by_its_sketch():
    equal = 0.75 + 0.25 * 0.25
    least = (0.25 + 0.75 * lsh_forest.LEAST_ESTIMATE) * lsh_forest.HASHES
    n = lsh_forest.HASHES
    assert sum(math.comb(n, k) * equal**k * (1 - equal) ** (n - k) for k in range(n + 1) if k < least) < 1e-8
    assert near([0, 44]) == [(0, 1)]  # an estimate of 0.54


def test_links_inside_a_crowded_region(spark):
    """A group of 1,000 documents on one template at similarities around 0.70, with pairs of them just above 0.75."""
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(10**6)}"
    template = [word() for _ in range(144)]
    rows = [(k, " ".join([*template, *(word() for _ in range(26))])) for k in range(1000)]
    for k in range(60):
        own = rows[k][1].split()[144:]
        rows.append((10_000 + k, " ".join([*template, *own[:9], *(word() for _ in range(17))])))
    sets = {d: shingle_set(t) for d, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    planted = [k for k in range(60) if alike(k, 10_000 + k) >= 0.75]
    assert len(planted) == 60 and max(alike(a, b) for a, b in ((1, 2), (3, 10_004), (500, 600))) < 0.75
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    recall = sum(got[k] == got[10_000 + k] for k in planted) / len(planted)
    print("recall of links in a crowded region:", recall)
    assert recall >= 0.9 and all(got[k] in (k, k - 10_000) for k in got)


def test_mixed_signatures_hold_each_value_once(spark):
    values = np.arange(lsh_forest.TREES * lsh_forest.DEPTH, dtype=">u2")
    rows = spark.createDataFrame([(bytearray(values.tobytes()),)], "signature binary")
    seen = set()
    for number in (1, 2):
        got = np.frombuffer(bytes(rows.select(mixed(F.col("signature"), number).alias("s")).first()["s"]), dtype=">u2").reshape(lsh_forest.TREES, -1)
        assert all(len(set(t)) == lsh_forest.DEPTH for t in got.tolist())
        seen |= {frozenset(t) for t in got.tolist()}
    assert len(seen) == 2 * lsh_forest.TREES


def test_sets_with_one_first_hash_stay_apart(spark):
    sets = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "node long, check long")
    renamed = clashes(sets)
    got = sorted((r["check"], r["node"]) for r in rename(sets, renamed).collect())
    assert len({n for _, n in got}) == 4 and [g for g in got if g[0] != 11] == [(10, 1), (20, 2), (30, 3)]
    assert clashes(sets.where("check <> 11")) is None


def test_what_the_rounds_leave_is_joined_exactly(spark, monkeypatch):
    """Rounds that hold each row against one other lose links of a crowd; the join on the rarest members has them all."""
    monkeypatch.setattr(lsh_forest, "ROUNDS", ((0, 1), (0, 1)))
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**9)}"
    template = [word() for _ in range(144)]
    rows = [(k, " ".join([*template, *(word() for _ in range(26))])) for k in range(400)]
    for k in range(40):
        own = rows[k][1].split()[144:]
        rows.append((10_000 + k, " ".join([*template, *own[:9], *(word() for _ in range(17))])))
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    root = {r["doc_id"]: r["component_id"] for r in found}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in rows)}
    linked = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 75 * len(x | y)]
    assert len(linked) >= 40 and all(root[a] == root[b] for a, b in linked)
    assert len(set(root.values())) == len(rows) - len({b for _, b in linked})


def test_a_crowd_is_compared_in_blocks(spark, monkeypatch):
    """What is joined exactly gives the links that join components, and no row for each pair of a crowd."""
    monkeypatch.setattr(lsh_forest, "BLOCK_NODES", 32)
    rng = random.Random(4)
    template = rng.sample(range(10**12), 150)
    sets = {k: {*template, *(rng.randrange(10**12) for _ in range(30))} for k in range(300)}  # 150 of 210 at most
    for k in range(20):
        sets[1000 + k] = {*sorted(sets[k])[: 160 + k % 3], *(rng.randrange(10**12) for _ in range(18))}
    alike = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 75 * len(x | y)]
    nodes = spark.createDataFrame([(k, struct.pack(f"<{len(m)}q", *sorted(m))) for k, m in sets.items()], "node long, members binary")
    roots = spark.createDataFrame([(1000, 0), (0, 0)], "node long, root long")
    found = [tuple(sorted(r)) for r in lsh_forest.sharing(nodes.select("node"), nodes, roots).collect()]
    assert alike and set(found) <= set(alike) and len(found) <= 2 * len(alike) < len(sets)

    def classes(links):
        least = {k: k for k in sets}
        for _ in range(len(sets)):
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        return least

    assert classes([*found, (0, 1000)]) == classes([*alike, (0, 1000)])
