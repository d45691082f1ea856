import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from chainloom.llm import words

TEXT = st.text(alphabet=st.sampled_from(list("aAbB éß中 \t\n\x0b\x0c\r\x1f\x85 .")), max_size=60)


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_equal_the_pattern(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string())], names=["text"])
    seen, hashed_of = [], {}
    for start, stop, data, offsets in words.chunks(batch, "text", 40):
        hashed, first = words.word_hashes(data, offsets)
        for k in range(stop - start):
            own = hashed[first[k] : first[k + 1]].tolist()
            expected = split(texts[start + k])
            assert len(own) == len(expected)
            for h, w in zip(own, expected, strict=True):
                assert hashed_of.setdefault(w, h) == h
        seen += range(start, stop)
    assert seen == list(range(len(texts)))
    assert len(set(hashed_of.values())) == len(hashed_of)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=6))
def test_shingles_equal_sets_of_tuples(lists):
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    values, owner = words.shingles(words.mix(np.array([w + 1 for x in lists for w in x], dtype=np.uint64)), first)
    distinct, at = words.distinct_per_text(values, owner, len(lists))
    names = {}
    for k, x in enumerate(lists):
        expected = {tuple(x[i : i + 5]) for i in range(len(x) - 4)} if len(x) >= 5 else {tuple(x)} - {()}
        own = values[owner == k].tolist()
        whole = [tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))] if x else []
        assert len(own) == len(whole) and at[k + 1] - at[k] == len(expected)
        for h, s in zip(own, whole, strict=True):
            assert names.setdefault(s, h) == h
    assert len(set(names.values())) == len(names)


def test_slices_and_empty_batches():
    array = pa.array(["x y", "z", None, "w"])
    batch = pa.RecordBatch.from_arrays([array.slice(1, 3)], names=["text"])
    (start, stop, data, offsets), = words.chunks(batch, "text")
    assert (start, stop) == (0, 3) and bytes(data) == b"zw" and offsets.tolist() == [0, 1, 1, 2]
    assert list(words.chunks(batch.slice(0, 0), "text")) == []
