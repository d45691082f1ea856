import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chainloom.llm.elias_fano import EliasFano
from chainloom.llm.ngram_trie import CUTOFFS, DISCOUNTS, score_documents


@pytest.mark.parametrize("top", [1, 50, 10**6, 2**62])
def test_sequences_find_and_get(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 100, 5000):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        sequence = EliasFano.encode(values)
        assert (sequence.get(np.arange(n)) == values).all()
        wanted = np.concatenate([values, rng.integers(0, top + 5, 300).astype(np.uint64)])
        at, equal = sequence.find(wanted)
        assert (at == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def brute(rows, cutoffs, discounts):
    train = [split(t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    grams = [Counter() for _ in range(3)]
    for text in train:
        for n in range(3):
            grams[n].update(tuple(text[i : i + n + 1]) for i in range(len(text) - n))
    total, distinct = sum(grams[0].values()), len(grams[0])
    follow = [{}, {}]
    for n in (1, 2):
        for gram, c in grams[n].items():
            s = follow[n - 1].setdefault(gram[:-1], [0, 0])
            if c >= cutoffs[n]:
                s[0] += c
                s[1] += 1

    def p(context, w):
        if not context:
            return (grams[0][(w,)] + 1) / (total + distinct + 1)
        lower, n = p(context[1:], w), len(context)
        whole = grams[n - 1][context]
        if not whole:
            return lower
        mass, kept = follow[n - 1].get(context, (0, 0))
        c = grams[n][(*context, w)]
        own = (c - discounts[n]) / whole if c and c >= cutoffs[n] else 0
        return own + (whole - mass + discounts[n] * kept) / whole * lower

    out = []
    for d, t in rows:
        text = split(t)
        base = sum(math.log10((grams[0][(w,)] + 1) / (total + distinct + 1)) for w in text)
        score = sum(math.log10(p(tuple(text[max(0, i - 2) : i]), w)) for i, w in enumerate(text))
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(text), sum(grams[0][(w,)] > 0 for w in text), total, base, score))
    return out


@pytest.mark.parametrize("bucket_tokens", [1 << 20, 150])
def test_scores_equal_brute_force(spark, bucket_tokens):
    rng = random.Random(4)
    vocabulary = ["the"] * 40 + ["of"] * 15 + [f"w{k}" for k in range(60)]
    rows = [(k, " \t".join(rng.choice(vocabulary).upper() if rng.random() < 0.1 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, "the of the"), (3, rows[3][1]), (502, "never seen"), (503, "the of " * 30000)]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, score int").repartition(3)
    got = sorted(score_documents(docs, bucket_tokens=bucket_tokens).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"]))
    expected = sorted(brute(rows, CUTOFFS, DISCOUNTS), key=lambda r: (str(r[0]), r[2]))
    for r, e in zip(got, expected, strict=True):
        assert tuple(r)[:5] == e[:5]
        assert abs(r["base_score"] - e[5]) <= 1e-9 * max(1, abs(e[5]))
        assert abs(r["score"] - e[6]) <= 4e-4 * e[2]


def test_empty_and_untrained(spark):
    schema = "doc_id long, text string"
    assert score_documents(spark.createDataFrame([], schema)).count() == 0
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    row = score_documents(spark.createDataFrame([(held, "a b")], schema)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)


def test_trigrams_seen_once_count(spark):
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    other = [d for d in range(100, 200) if zlib.crc32(str(d).encode()) % 7 != 2]
    rng = random.Random(9)
    # the bigrams of the passage are frequent in other company, its trigrams are seen once
    rows = [(d, " ".join(rng.choice("abcdefgh") for _ in range(30))) for d in other]
    passage = "once one a two b three c four"
    rows += [(None, t) for t in ("x one a y", "x a two y", "x two b y", "x b three y")]
    rows += [(None, passage), (held, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in score_documents(docs).collect() if r["doc_id"] is not None}
    expected = {d: s for d, *_, s in brute(rows, (1, 1, 1), DISCOUNTS) if d is not None}
    assert all(abs(got[d] - expected[d]) <= 4e-4 * 40 for d in expected)
    assert expected[held] > {d: s for d, *_, s in brute(rows, (1, 1, 2), DISCOUNTS)}[held] + 0.1
