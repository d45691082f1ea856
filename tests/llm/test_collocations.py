"""Collocations against a plain count of every run, cut and extension."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainloom.llm import collocations as co


def plain_words(piece):
    return re.findall(r"[^\x20\x09]+", piece)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counts(rows, most):
    found = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = plain_words(piece)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    found[lang or "und"][tuple(w[i : i + k])] += 1
    return found


def brute(rows, least, most, limit):
    out = []
    for lang, f in counts(rows, most).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        chosen = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in chosen.items():
            if any(len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) and 100 * b >= 50 * a for h, b in chosen.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, rank, g.decode(), -a, l, r, n, -s) for rank, (s, a, g, l, r) in enumerate(sorted(kept)[:limit], 1)]
    return sorted(out)


def ask(spark, rows, **more):
    docs = spark.createDataFrame([(k, *r, "x") for k, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string")
    return sorted(map(tuple, co.collocations(docs, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed, texts=60, length=80):
    rng = random.Random(seed)
    sep = [" "] * 20 + [". ", ",", "\t", "  ", "\n", "!", "\r\n", ";"]
    vocabulary = ["New", "york", "CITY", "the", "a", "é", "中", "don't", "x-y"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(texts):
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocabulary) + rng.choice(sep) for _ in range(rng.randrange(length)))))
    return rows + [("en", None), ("en", ""), ("fr", " . "), *rows[:5]]


@pytest.mark.parametrize(("seed", "least", "most"), [(1, 10, 3), (2, 3, 4), (3, 2, 2)])
def test_equal_to_brute_force(spark, seed, least, most):
    rows = corpus(seed)
    assert ask(spark, rows, least=least, most_words=most, limit=40, chunk=200) == brute(rows, least, most, 40)


def test_empty_and_rare(spark):
    assert ask(spark, []) == []
    assert ask(spark, [("en", "a b"), (None, None)]) == []


def test_one_long_text_and_large_groups_are_ranked_in_shares(spark, monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choice("abcdefgh") for _ in range(30_000))
    monkeypatch.setattr(co, "RANKED_ROWS", 10)
    rows = [("en", text)]
    assert ask(spark, rows, limit=25, chunk=1000) == brute(rows, 10, 3, 25)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBé中 \t.,\n\x0b\x85")), max_size=40), max_size=6), st.integers(1, 30), st.integers(1, 3))
def test_runs_of_chunks(texts, chunk, size):
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts), type=pa.string()), pa.array(texts, type=pa.string())], names=["lang", "text"])
    got = Counter()
    for rows in co.runs(batch, size, 3, None, chunk):
        for phrase, a in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
            got[phrase] += a
    words = got.pop(None, 0)
    expected = {" ".join(g): c for g, c in counts([("en", t) for t in texts], 3)["en"].items() if len(g) == size}
    assert dict(got) == expected
    assert size > 1 or words == sum(expected.values())


def test_scores_pass_64_bits_exactly(spark):
    big = [(10**13 + 7, 10**13 + 9, 3 * 10**13 + 1), (99_999_999_999_999, 99_999_999_999_999, 99_999_999_999_999), (10, 12, 11)]
    rows = spark.createDataFrame(big, "a long, l long, r long").select("a", "l", "r", co.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r["s"] for r in rows] == [1_000_000 * r["a"] ** 2 // (r["l"] * r["r"]) for r in rows]


def test_the_bitmap_holds_all_frequent_runs(spark):
    phrases = [("en", f"w{i} v{i}") for i in range(3000)] + [("de", "a b")]
    frame = spark.createDataFrame(phrases, "lang string, phrase string")
    bits = co._bitmap(frame, len(phrases))
    tongue = co._hashes(pa.array([p[0] for p in phrases]))
    parts = [co._hashes(pa.array([p[1].split()[k] for p in phrases])) for k in (0, 1)]
    assert co._has(bits, co._join_hash(tongue, parts)).all()
    assert co._has(bits, co._join_hash(tongue, parts[::-1])).mean() < 0.2
