import itertools
import math
import random
import re

import numpy as np
import pytest

from chainloom.llm import ordinal, words


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    rows, marks = [], []
    for k in range(n):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        kind = k % 4
        if kind == 0:
            text.insert(rng.randrange(len(text)), rng.choice(["badword", "awful"]))
        if kind == 1:
            text = [w.upper() + "!!" for w in text]
        rows.append((k, " ".join(text)))
        marks.append((k, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    return rows, marks


def test_held_out_accuracy(spark):
    rows, marks = corpus(1200, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks[:800], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in ordinal.classify(docs, labels).collect()}
    assert len(got) == 1200
    right = sum(got[k]["kept"] == (q == 1 and t == 0) for k, q, t in marks[800:])
    assert right >= 0.95 * 400
    toxic = np.mean([got[k]["expected_grade"] for k, q, t in marks[800:] if t])
    good = np.mean([got[k]["expected_grade"] for k, q, t in marks[800:] if q and not t])
    assert toxic < 0.7 < 1.5 < good
    assert all(got[k]["p_above_toxic"] >= got[k]["p_good"] for k in got)


def test_odd_rows(spark):
    rows, marks = corpus(80, 1)
    rows += [(None, "x"), (500, None), (501, ""), (502, "long " * 60000), (3, rows[3][1])]
    docs = spark.createDataFrame([(a, b, 1.0) for a, b in rows], "doc_id long, text string, kept double")
    labels = spark.createDataFrame([*marks, (None, 1, 0), (500, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert ordinal.classify(docs, labels).count() == len(rows)
    kept = ordinal.reject(docs, labels)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and 0 < kept.count() <= len(rows)
    assert ordinal.classify(docs.limit(0), labels).count() == 0
    assert ordinal.classify(docs, labels.limit(0)).where("kept").count() == len(rows)


def test_thresholds_are_ordered():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, ordinal._NUMBERS))
    y = np.digitize(x[:, 0], [-0.5, 0.5])
    model = ordinal.fit((int(g), np.zeros(0, np.uint32).tobytes(), v.tobytes()) for g, v in zip(y, x, strict=True))
    assert model.thresholds[0] < model.thresholds[1]
    tails = model.tails(x @ model.weights)
    assert np.mean((tails > 0.5).sum(axis=1) == y) > 0.85


@pytest.mark.parametrize("text", ["", "   ", "a", "!!!"])
def test_features_of_short_texts(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    values, at, numbers = ordinal.features(data, np.array([0, len(data)]))
    assert at[-1] == len(values) and numbers.shape == (1, ordinal._NUMBERS)


def hashed(text, lower=True):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return int(words.hash_words(data, np.array([0]), np.array([len(data)]), lower)[0])


def score_of(text, model):
    """The model's score of one text, word by word."""
    lower = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    found, shapes = set(), []
    for w in parts:
        kinds = "".join("A" if "A" <= c <= "Z" else "a" * len(c.encode()) if "a" <= c <= "z" or ord(c) > 127 else "0" if "0" <= c <= "9" else c for c in w)
        shapes.append(kinds)
        bare = "".join(c for c, k in zip(w, w, strict=True) if c.isascii() and c.isalpha() or ord(k) > 127)
        if bare:
            found.add(hashed(bare) >> (64 - ordinal.HASH_BITS))
        found.add((hashed("".join(k for k, _ in itertools.groupby(kinds)), False) ^ int(ordinal._SHAPE_SALT)) >> (64 - ordinal.HASH_BITS))
    n = len(parts)
    share = lambda f: sum(map(f, shapes)) / max(n, 1)
    signs = lambda k: sum(c not in "aA0" for c in k)
    again = 1 - len(set(map(lower, parts))) / max(n, 1)
    same = sum(lower(a) == lower(b) for a, b in itertools.pairwise(parts)) / max(n, 1)
    numbers = [share(lambda k: 2 * k.count("A") > len(k)), share(lambda k: signs(k) >= 2), share(lambda k: signs(k) == len(k)), same, share(lambda k: len(k) > 20), again if n > 50 else 0, float(n > 50 and again > 0.8), float(n == 0), 1]
    where = {int(k): w for k, w in zip(model.keys, model.weights, strict=False)}
    return sum(where.get(f, 0.0) for f in found) + float(np.dot(numbers, model.weights[len(model.keys) :]))


def test_scores_equal_brute_force(spark):
    rows, marks = corpus(200, 3)
    rows += [(1000, None), (1001, ""), (1002, "Ünï-cödé badword " * 30), (1003, "!!! ### 12:30 12:30 " + "q" * 50)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = ordinal.train(docs, labels)
    assert len(model.keys)
    for r in ordinal.classify(docs, labels).join(docs, "doc_id").collect():
        score = score_of(r["text"] or "", model)
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert math.isclose(r["p_above_toxic"], tails[0], abs_tol=1e-6) and math.isclose(r["p_good"], tails[1], abs_tol=1e-6)
        assert math.isclose(r["expected_grade"], sum(tails), abs_tol=1e-6) and r["kept"] == (r["p_good"] >= ordinal.LEAST_TAIL)


def test_features_are_chosen_by_association(spark):
    rows = [(k % 3, np.unique(np.array([1, 2 + k % 3, 10 + k], dtype=np.uint32))) for k in range(300)]
    sample = spark.createDataFrame([(g, bytearray(v.tobytes())) for g, v in rows], "grade int, hashed binary")
    assert ordinal.informative(sample).tolist() == [2, 3, 4]  # 1 is in all, those from 10 on in one each
    assert ordinal.informative(sample.limit(0)).tolist() == []


def test_long_rated_documents_are_learnt_from(spark):
    long = "filler " * 10_000  # more than 64 KiB
    rows = [(k, long + ("dreadful" if k % 2 else "pleasant")) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in range(100)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in ordinal.classify(docs, labels).collect()}
    assert all(got[k] == (k % 2 == 0) for k in range(120))


def test_the_sample_is_filled_from_documents_that_have_a_text(spark, monkeypatch):
    """Labels of no document do not count, and of rows that repeat an id one is learnt from."""
    rows = [(k, f"good words here {k}" if k % 2 else "bad stuff there") for k in range(40)] + [(1, "good words here 1")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(k, 1, 0) for k in range(1000, 3000)], "doc_id long, quality int, toxic int")
    seen = []
    plain = ordinal.fit

    def fit(sample, keys):
        seen.extend(sample)
        return plain(iter(seen), keys)

    monkeypatch.setattr(ordinal, "fit", fit)
    ordinal.train(docs, labels, sample=30)
    assert len(seen) == 30
