import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chainloom.llm import ordinal, tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def make(path, spark):
    rng = random.Random(11)
    vocabulary = [f"word{k}" for k in range(2000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(draw(40))) for k in range(5)]
    docs, labels = [], []
    for d in range(400):
        text = draw(rng.randrange(30, 200))
        toxic = d % 5 == 4
        if toxic:
            text.insert(rng.randrange(len(text)), "badword")
        if d % 20 == 1:
            text[5:5] = items[d % 3][1].split()
        if d % 20 == 2:
            text = docs[-2][1].split()
            text[3] = "changed"
        docs.append((d, " ".join(text), "en", "src", None))
        labels.append((d, 1, int(toxic)))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_all_stages_take_effect(spark, tmp_path):
    docs = make(str(tmp_path), spark)
    encode = Tokenizer.from_file(tokenizer.default_path())
    where = f"file://{tmp_path}"
    rejected = {r["doc_id"] for r in ordinal.classify(spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")).where("not kept").collect()}
    assert rejected == {d for d in range(400) if d % 5 == 4 or "badword" in docs[d][1].split()}
    # copies of d - 2 lie at d % 20 == 2; the benchmark's items at d % 20 == 1
    expected = {d for d in range(400) if d not in rejected and d % 20 not in (1, 2)}
    got = corpus_pipeline.run(spark, where).orderBy("sequence_id", "offset").collect()
    assert {r["doc_id"] for r in got} == expected
    for d in sorted(expected)[:25]:
        ids = [*encode.encode(docs[d][1], add_special_tokens=False).ids, 1]
        pieces = sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path):
    make(str(tmp_path), spark)
    where = f"file://{tmp_path}"
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, where).columns == docs.columns, name
        assert stage(spark, docs.limit(0), where).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), where).count() == 0


def test_stages_stand_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "some plain words of a text that is fine", "en", None, None), (1, "some plain words of a text that is fine", "en", None, None), (2, None, None, "s", 0), (None, "words without an id", "en", "s", 3), (3, "", "en", "s", 0), (4, "long " * 50000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit(7) for c in ("c0", "text__", "kept", "p_good", "mark", "mark0", "ids", "part", "item_id")})
    spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "x"), (2, "far too short")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    where = f"file://{tmp_path}"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, where)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        assert got.count() == (5 if name == "near_dedup" else 6), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, where).select("doc_id").distinct().count() == 5
