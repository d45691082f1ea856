"""The audit against a plain walk through all orders of the filters."""

import itertools
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainloom.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, source string, mask string, part string"


def fails(rows):
    texts = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            texts.setdefault(text or "", set()).add(doc_id)
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(other < doc_id for other in texts.get(text, ())),
        })
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    marks, out = fails(rows), []
    for part in {r[2] or "" for r in rows}:
        own = [(r, m) for r, m in zip(rows, marks, strict=True) if (r[2] or "") == part]
        shapley, lines = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                redundant = sum(m[f] and any(m[g] for g in order[: step - 1]) for _, m in own)
                unique = sum(m[f] and sum(m.values()) == 1 for _, m in own)
                shapley[f] += len(removed)
                lines.append((part, "".join(order), step, f, len(left), len(removed), redundant, unique, sum(r[0] in good for r, _ in removed), sum(r[0] in toxic for r, _ in removed)))
        out += [(*x, shapley[x[3]]) for x in lines]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def ask(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "m", "p") for r in rows], SCHEMA)
    return sorted(map(tuple, fa.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).select(*COLUMNS).collect()))


def corpus(seed, n=80):
    rng = random.Random(seed)
    long = " ".join(f"word{i}" for i in range(400))
    texts = [None, "", " ", "a b", "A B", "#", long, long + " x", long[:-1] + "9", " ".join(["same"] * 60), " ".join(f"W{i}" for i in range(70)), " ".join(f"w{i}" for i in range(60)), "w" * 70_000, "w" * 69_999 + "v"]
    rows = [(rng.choice([None, *range(40)]) if rng.random() < 0.3 else k, rng.choice(texts), rng.choice(["s", "t", None, "", "with space"])) for k in range(n)]
    return rows + rows[:4]


LABELS = [(k, k % 3 % 2, (k + 1) % 4 % 2) for k in range(30)] + [(1, None, 1), (None, 1, 1), (2, 1, None), (2, 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, seed):
    rows = corpus(seed)
    assert ask(spark, rows, LABELS) == brute(rows, LABELS)


def test_hashes_that_collide_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(fa, "block_hash", lambda block: F.lit(7).cast("long"))
    monkeypatch.setattr(fa, "SHARE_ROWS", 3)
    rows = [(k, t, "s") for k, t in enumerate(["aa", "bb", "aa", "cc", "bb", "cc", "cc", "dd", "aa", None, ""])]
    assert ask(spark, rows, LABELS) == brute(rows, LABELS)


def test_many_classes_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(fa, "BROADCAST_CLASSES", 0)
    monkeypatch.setattr(fa, "SHARE_ROWS", 2)
    rows = corpus(3)
    assert ask(spark, rows, LABELS) == brute(rows, LABELS)


def test_empty_tables(spark):
    assert ask(spark, [], LABELS) == []
    assert len(ask(spark, [(1, "a", "s")], [])) == 600


def test_refinement_drops_single_rows_at_once(spark):
    rows = spark.createDataFrame([(1, "a" * 600 + "x", "s"), (2, "a" * 600 + "y", "s"), (3, "b", "s"), (4, "b", "s"), (5, "ccc", "s")], "doc_id long, text string, part string")
    found = fa.refine(fa._keys(rows).select("doc_id", *fa.KEY)).select("points", "rows", "first").collect()
    assert [tuple(r) for r in found] == [(1, 2, 3)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é中 \t\n\x0b\x0c\r\x1f\x85\xa0")), max_size=60), st.integers(1, 20))
def test_words_of_pieces(text, piece):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert fa.count_words(text.encode(), piece) == (len(w), len(set(w)))
