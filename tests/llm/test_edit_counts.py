import random
import re
import time

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainloom.llm import tokenizer
from chainloom.llm.edit_counts import MASKS, CountTree, count_edited, keep_trees, recount, with_mask_edits

ALPHABET = ["a", "B", " ", "  ", "\n", "'s", "'re", "'", "9", "é", "ñandú", "!!", "\t ", "word", "<email>", "中文", " "]


def brute(text):
    encode = tokenizer.load(tokenizer.default_path())
    return len(encode.encoding.encode_ordinary(text))


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_edits_equal_a_fresh_count(leaf):
    count = tokenizer.load(tokenizer.default_path()).count
    rng = random.Random(leaf)
    for _ in range(150):
        tree = CountTree("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))), count, leaf)
        assert tree.tokens == brute(tree.text)
        for _ in range(6):
            a = rng.randrange(0, len(tree.text) + 1)
            b = min(len(tree.text), a + rng.choice([0, 1, 2, 9]))
            tree.edit(a, b, "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 4))))
            assert tree.tokens == brute(tree.text)
            assert sum(sum(s) for s, _ in tree.leaves) == len(tree.text) == tree.sums[1][0]


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_edits_of_kept_trees_equal_a_fresh_count(leaf):
    count = tokenizer.load(tokenizer.default_path()).count
    rng = random.Random(70 + leaf)
    for _ in range(200):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60)))
        tree = CountTree(text, count, leaf, CountTree(text, count, leaf).leaf_sums())
        assert tree.encoded == 0 and tree.tokens == brute(text)
        for _ in range(5):
            a = rng.randrange(0, len(tree.text) + 1)
            b = min(len(tree.text), a + rng.choice([0, 1, 2, 15]))
            tree.edit(a, b, "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 4))))
            assert tree.tokens == brute(tree.text) and tree.sums[1][0] == len(tree.text)
        again = CountTree(tree.text, count, leaf, tree.leaf_sums())
        again.edit(0, len(tree.text) // 2, "x ")
        assert again.tokens == brute(again.text)


def test_kept_trees_as_tables(spark):
    text = "some words here and there " * 4000
    docs = spark.createDataFrame([(1, text), (2, None), (3, "short 12 (555) 123-4567")], "doc_id long, text string")
    edits = with_mask_edits(docs).withColumn("edits", F.when(F.col("doc_id") == 1, F.array(F.struct(F.lit(50000).alias("start"), F.lit(50005).alias("end"), F.lit("changed").alias("new")))).otherwise(F.col("edits")))
    got = {r["doc_id"]: r for r in recount(edits.join(keep_trees(docs), "doc_id")).collect()}
    assert all(r["n_tokens"] == brute(r["text"]) == sum(r["leaf_tokens"]) for r in got.values())
    assert got[1]["n_encoded"] < 300 and got[1]["text"][50000:50007] == "changed"


def test_an_edit_leaves_most_pretokens_alone():
    count = tokenizer.load(tokenizer.default_path()).count
    tree = CountTree("some words here and there " * 2000, count)
    tree.edit(20000, 20005, "other")
    assert tree.encoded < 8


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_leaves_stay_bounded(leaf):
    """Large insertions and deletions split leaves; later edits still encode a few leaves only."""
    count = tokenizer.load(tokenizer.default_path()).count
    rng = random.Random(leaf)
    tree = CountTree("some words here and there " * 20, count, leaf)
    for size in (3000, 1, 500, 0, 7):
        a = rng.randrange(0, len(tree.text) + 1)
        tree.edit(a, a + 40, "".join(rng.choice(ALPHABET) for _ in range(size)))
        assert tree.tokens == brute(tree.text) and max(len(s) for s, _ in tree.leaves) <= 2 * leaf
        assert [len(t) for t in tree.texts] == [c for c, _ in tree.leaf_sums()]
    before = tree.encoded
    tree.edit(len(tree.text) // 2, len(tree.text) // 2 + 1, "z")
    assert tree.tokens == brute(tree.text) and tree.encoded - before <= 8 * leaf + 32


def test_the_query_encodes_near_its_edits_only(spark):
    text = "plain words without any data " * 3000 + "mail a@b.org " + "and some more words " * 3000
    r = count_edited(with_mask_edits(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert r["n_edits"] == 2 and r["n_encoded"] <= 4 * 64 < r["n_pretokens"] / 50
    assert r["n_tokens"] == brute(text) and r["n_tokens_edited"] == brute(text.replace("a@b.org", "<email>") + "\n")


def test_rows(spark):
    text = "write to a.b@c.org or (555) 123-4567 now"
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, None, "x"), (None, "", "x"), (3, "word " * 40000, None)], "doc_id long, text string, edits string")
    docs = docs.drop("edits")
    rows = count_edited(with_mask_edits(docs), with_text=True).collect()
    assert len(rows) == 5
    for r in rows:
        assert r["n_tokens_edited"] == brute(r["text_edited"])
    assert sum(r["text_edited"] == "write to <email> or <phone> now\n" for r in rows) == 2
    assert with_mask_edits(docs.limit(0)).count() == 0 and count_edited(with_mask_edits(docs.limit(0))).count() == 0


PLAIN_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab.@@_%- é")), max_size=30))
def test_the_mask_of_names_finds_what_a_plain_pattern_finds(text):
    masks = [(m.start(), m.end()) for m in regex.finditer(MASKS["<email>"], text)]
    assert masks == [(m.start(), m.end()) for m in re.finditer(PLAIN_EMAIL, text)]


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " @", "a." * 500_000 + "@", "x@" + "a-" * 500_000, "a@" * 500_000, "(" * 1_000_000, "1." * 500_000])
def test_masks_read_a_text_once(text):
    began = time.monotonic()
    for pattern in MASKS.values():
        for _ in regex.finditer(pattern, text):
            pass
    assert time.monotonic() - began < 3


def test_an_edit_over_many_leaves_joins_them_once():
    count = tokenizer.load(tokenizer.default_path()).count
    took = []
    for n in (200_000, 800_000):
        tree = CountTree("word and " * n, count, 16)
        began = time.monotonic()
        tree.edit(0, len(tree.text), "")
        took.append(time.monotonic() - began)
        assert tree.tokens == 0 and tree.text == ""
    assert took[1] < 10 * took[0] + 0.2


def test_edits_that_join_leaves_count_as_a_fresh_text():
    count = tokenizer.load(tokenizer.default_path()).count
    rng = random.Random(5)
    for _ in range(60):
        tree = CountTree("".join(rng.choice(["a", " ", "   ", "\n\n", "b", "1"]) for _ in range(rng.randrange(40, 200))), count, 2)
        for _ in range(4):
            a, n = rng.randrange(0, len(tree.text) + 1), rng.choice([0, 3, 40, 150])
            tree.edit(a, min(len(tree.text), a + n), rng.choice(["", " ", "x", "\n" * 30]))
            assert tree.tokens == brute(tree.text) and sum(sum(s) for s, _ in tree.leaves) == len(tree.text)
