import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from chainloom.llm import tokenizer
from chainloom.llm.packing import pack


def test_ids_equal_the_tokenizers_library():
    own, theirs = tokenizer.load(tokenizer.default_path()), Tokenizer.from_file(tokenizer.default_path())
    rng = random.Random(0)
    alphabet = ["a", "The", " ", "\n\n", "  ", "'ll", "é", "ß", "中", "🙂", "\u0000", "123", "!?", "<|endoftext|>", "\t", " ", "x" * 300]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert own(text) == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_white_space_and_long_words():
    own, theirs = tokenizer.load(tokenizer.default_path()), Tokenizer.from_file(tokenizer.default_path())
    for text in (" " * 1_000_000, " " * 5_000_000, "\n" * 1_100_000 + "end", "a b" + "\t" * 5000 + " c", "x" + "\u3000" * 4096, " " * 4095 + "!", "7" + " \n" * 3000 + "\x1c", "w" * 200_000, "<|endoftext|>" + " " * 9000 + "<|endoftext|> z"):
        assert own(text) == theirs.encode(text, add_special_tokens=False).ids, repr(text[:20])


def test_a_very_long_text_is_packed_whole(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "tail")], "doc_id long, text string")
    got = pack(docs, with_ids=False)
    assert got.where("doc_id = 1").agg({"length": "sum"}).first()[0] == 1_000_001
    assert got.where("doc_id = 2").agg({"length": "sum"}).first()[0] == len(tokenizer.load(tokenizer.default_path())("tail")) + 1


def test_pieces_cover_every_id_once(spark):
    rng = random.Random(1)
    texts = [None, "", "word", *(" ".join(rng.choice(["alpha", "beta", "ñu"]) for _ in range(rng.randrange(900))) for _ in range(40)), "again " * 9000]
    rows = [*enumerate(texts), (3, texts[3]), (None, "no id")]
    docs = spark.createDataFrame([(a, b, "clash") for a, b in rows], "doc_id long, text string, part string").repartition(3)
    got = pack(docs, length=256).collect()
    encode = Tokenizer.from_file(tokenizer.default_path())
    expected = sorted((str(d), [*encode.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows)
    where = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    joined, spans = [], {}
    for k, r in enumerate(where):
        ids = np.array(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        assert r["offset"] == sum(x["length"] for x in where if x["sequence_id"] == r["sequence_id"] and x["offset"] < r["offset"])
        if r["start"] == 0:
            joined.append((str(r["doc_id"]), []))
        assert len(joined[-1][1]) == r["start"]
        joined[-1][1].extend(r["ids"])
        spans[r["sequence_id"]] = spans.get(r["sequence_id"], 0) + r["length"]
    assert sorted(joined) == expected
    assert all(n == 256 for s, n in spans.items() if s != max(spans)) and set(spans) == set(range(len(spans)))
    assert pack(docs.limit(0)).count() == 0
