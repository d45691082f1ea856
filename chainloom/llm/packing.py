"""Packing by concatenating all documents' tokens and cutting at fixed windows.

Pass one encodes every document once and keeps the ids as a table, with each document's offset in its partition.
The partitions' totals, summed in order, give each partition's offset in the whole; pass two cuts the documents at
multiples of the sequence length. Only one total per partition passes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch, tokenizer

SEQUENCE = 2048
END_ID = 1


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, part, local_start, n_tokens, ids (binary, little-endian uint32 or, where they fit, uint16)."""
    scratch.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer.load(vocabulary)
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 512):
                some = texts.slice(lo, 512).to_pylist()
                ids = [np.append(encode.array(t or ""), np.uint32(end_id)).astype(encode.dtype) for t in some]
                sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                starts = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                blobs = [x.tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array(np.full(len(ids), part, dtype=np.int32)), pa.array(starts), pa.array(sizes), pa.array(blobs, type=pa.binary())], names=["doc_id", "part", "local_start", "n_tokens", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, part int, local_start bigint, n_tokens bigint, ids binary")


def cut(tokens: DataFrame, width: int, length: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """Pieces of the documents of ``encode_documents`` (already kept as a table), one for each sequence they touch."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    offsets, at = {}, 0
    for row in totals:
        offsets[row["part"]] = at
        at += row["n"]
    shared = tokens.sparkSession.sparkContext.broadcast(offsets)  # one number per partition
    dtype = "<u2" if width == 2 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, starts, sizes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            begin = starts + np.fromiter((base[p] for p in parts.tolist()), dtype=np.int64, count=len(parts))
            first, last = begin // length, (begin + sizes - 1) // length
            n = last - first + 1
            row = np.repeat(np.arange(len(n)), n)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            lo = np.maximum(sequence * length, begin[row])
            hi = np.minimum((sequence + 1) * length, (begin + sizes)[row])
            start, size = lo - begin[row], hi - lo
            blobs, crcs, pieces, seen, ids = batch.column(4), [], [], -1, None
            for r, s, m in zip(row.tolist(), start.tolist(), size.tolist(), strict=True):
                if r != seen:
                    seen, ids = r, np.frombuffer(blobs[r].as_buffer(), dtype=dtype).astype("<u4")
                piece = ids[s : s + m].tobytes()
                crcs.append(zlib.crc32(piece))
                if with_ids:
                    pieces.append(ids[s : s + m])
            columns = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(size), pa.array(crcs, type=pa.int64()), pa.array(sizes[row]), pa.array(sequence), pa.array(lo - sequence * length)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in pieces], type=pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(tokens.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids
    return tokens.mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens; every sequence but the last one is full.

    A null or empty text is the end id alone. Repeated rows are packed each for itself, and rows with a null doc_id
    like all others. A text of any length is cut into as many sequences as it fills, and a long run of white space is
    encoded like any other. An empty table has no pieces. Only doc_id and text are read, so further columns cannot clash.
    """
    vocabulary = vocabulary or tokenizer.default_path()
    tokens = scratch.keep(encode_documents(docs, vocabulary, end_id), "tokens")
    return cut(tokens, np.dtype(tokenizer.load(vocabulary).dtype).itemsize, length, with_ids)
