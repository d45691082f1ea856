"""Cross-parsing against a plain search for each phrase, and accuracy on documents that nothing is learnt from."""

import os
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainloom.llm import cross_parse as cp

DATA = os.environ.get("LLM_TEST_DATA", "/root/testdata/sf0.001")


def plain_phrases(text, known, size):
    """Phrases of a text, found by searching the sample for longer and longer runs."""
    count = 0
    for at in range(0, len(text), size):
        segment, i = text[at : at + size], 0
        while i < len(segment):
            j = i + 1
            while j < len(segment) and segment[i : j + 1] in known:
                j += 1
            count, i = count + 1, j
    return count


TEXT = st.text(alphabet=st.sampled_from(list("aab é中")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(TEXT, max_size=6), st.integers(1, 20))
def test_phrases_equal_a_plain_search(known, texts, size):
    known, texts = known.encode(), [t.encode() for t in texts]
    model = cp.Automaton.of("x", len(known), *cp.suffix_automaton(known))
    columns, lengths, owner = cp.segments(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), size)
    got = np.bincount(owner, weights=model.phrases(columns, lengths), minlength=len(texts)) if len(texts) else []
    assert list(got) == [plain_phrases(t, known, size) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40))
def test_the_automaton_knows_all_runs_and_no_others(text):
    keys, states = cp.suffix_automaton(text)
    step = {int(k): int(s) for k, s in zip(keys, states, strict=True)}
    rng = random.Random(1)
    for _ in range(60):
        i = rng.randrange(len(text) + 1)
        run = text[i : i + rng.randrange(6)] + bytes(rng.choices(text or b"x", k=rng.randrange(2)))
        state = 0
        for c in run:
            state = step.get(state << 8 | c) if state is not None else None
        assert (state is not None) == (run in text)


def plain_letters(text):
    return re.sub(r"[\W\d_]+", " ", text.lower()).strip(" ")


WORDS = {"en": "the of and to in is was for that with".split(), "de": "der die und das ist nicht mit für ein über".split(), "zh": "我们 他们 的是 不在 有人".split()}


def corpus(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(sorted(WORDS))
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", " 42", "!"]) for _ in range(rng.randrange(1, 40)))
        rows.append((k, text.upper() if rng.random() < 0.1 else text, lang if rng.random() < 0.9 else None))
    return rows + [(1000, None, "en"), (1001, "", "en"), (1002, "12 #!", "de"), (1003, "x", None), (None, "der die", None), rows[0]]


def ask(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1.0, "y") for r in rows], "doc_id long, text string, lang string, score double, plain string")
    found = cp.identify(docs, ~cp.is_held_out(F.col("doc_id")), **more).collect()
    return sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in found), key=str)


def brute(spark, rows, size):
    """With the operator's own samples, whose bound no language reaches here: every text of the training fold once."""
    learnt = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = spark.createDataFrame([(lang, t) for _, t, lang in learnt], "lang string, text string")
    pieces = {}
    for r in cp.sample(docs).orderBy("lang", "draw", "piece").collect():
        pieces.setdefault(r["lang"], []).append(r["piece"])
    for lang, found in pieces.items():
        assert sorted(found) == sorted({plain_letters(t) for _, t, l in learnt if l == lang and t and plain_letters(t)})
    known = {lang: " ".join(p).encode() for lang, p in pieces.items()}
    out = []
    for doc_id, text, _ in rows:
        data = plain_letters(text or "").encode()
        if not data:
            out.append((doc_id, "und", 0.0))
            continue
        cost = sorted((plain_phrases(data, s, size) * np.log2(len(s) + 2.0) / len(data), lang) for lang, s in known.items())
        out.append((doc_id, cost[0][1], 1 - cost[0][0] / cost[1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "size"), [(1, 512), (2, 16)])
def test_equal_to_brute_force(spark, seed, size):
    rows = corpus(seed)
    got, expected = ask(spark, rows, segment=size), brute(spark, rows, size)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[2] for g in got], [e[2] for e in expected])


def test_nothing_to_learn_from(spark):
    assert ask(spark, [(1, "abc", None), (2, None, "en")]) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert ask(spark, []) == []
    assert ask(spark, [(1, "abc", "en"), (2, "?", "en")]) == [(1, "en", 1.0), (2, "und", 0.0)]


def test_samples_are_bounded_and_copies_count_once(spark):
    rows = [("en", "copy " * 100)] * 500 + [("en", f"{chr(97 + k % 26)}{chr(97 + k // 26)} " + "abc " * 100) for k in range(400)] + [("de", "kurz")]
    found = cp.sample(spark.createDataFrame(rows, "lang string, text string"), total=20_000, most=6_000, of_text=300).collect()
    size = {lang: sum(len(r["piece"]) for r in found if r["lang"] == lang) for lang in ("en", "de")}
    assert 5_700 <= size["en"] <= 6_300 and size["de"] == 4
    assert len({r["piece"] for r in found}) == len(found)
    few = [("en", "copy " * 100)] * 5000 + [("en", "other " * 100)]
    assert len(cp.sample(spark.createDataFrame(few, "lang string, text string"), total=2000, most=1000, of_text=300).collect()) == 2


def test_one_very_long_text(spark):
    rows = [*corpus(3), (5000, " ".join(["der die das und", "nicht mit über"] * 60_000), None)]
    assert next(r for r in ask(spark, rows) if r[0] == 5000)[1] == "de"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = cp.classify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out and n_chars >= 40").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in found) / len(found)
    assert len(found) > 20 and right >= 0.97
