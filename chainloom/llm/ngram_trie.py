"""An n-gram model in an Elias-Fano trie, built and queried by Spark tasks.

Level 1 holds the distinct words in the order of their hashes; a word's id is its place there. A node of level k is
an n-gram of k words: its key is (node of its first k-1 words, id of its last word), and its place in the order of
keys is its own number. Levels are cut into buckets of about equal numbers of tokens, even within one frequent
context, and each bucket is one file: the words of each context's successors, made monotone by the context's rank, and
pointers to each context's first successor are Elias-Fano sequences; the discounted probability of each node and
the weight that each context leaves to shorter ones are 16-bit codes of their logarithms.

Probabilities are interpolated with absolute discounts:
    p_k(w | context) = max(c - d_k, 0) / c(context) + weight(context) * p_{k-1}(w | shorter context),
    p_1(w) = (c(w) + 1) / (N + V + 1).
A level leaves out n-grams that occur less often than its cutoff; their mass stays in the context's weight.

Tasks map the levels' files and look up all n-grams of a chunk of text in the order of their keys, so that neither
the model nor the texts have to be shuffled for scoring. Only a few numbers for each bucket reach the driver.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch, words
from chainloom.llm.elias_fano import EliasFano

U64 = np.uint64
ORDER = 3
CUTOFFS = (1, 1, 1)
DISCOUNTS = (0.0, 0.9, 0.75)
#: Tokens in a bucket, and bytes of text whose n-grams are counted or looked up together.
BUCKET_TOKENS, CHUNK = 4 << 20, 4 << 20
HELD_OUT, FOLDS = 2, 7
END = int(words.mix(np.array([0xE0D], dtype=U64))[0])
_STEP = 6000.0  # codes a factor of ten


def _squeeze(values: np.ndarray) -> bytes:
    """Sorted or small values as differences, byte by byte, compressed."""
    gaps = np.diff(values.astype(U64), prepend=U64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _spread(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(U64).ravel(), dtype=U64)


def code(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-10)) * _STEP), 0, 65535).astype(np.uint16)


def decode(codes: np.ndarray) -> np.ndarray:
    return 10.0 ** (-codes.astype(np.float64) / _STEP)


def write_arrays(path: str, meta: dict, arrays: dict[str, np.ndarray]) -> None:
    """One file: a JSON line with the place of each array, then the arrays, each at a multiple of 8 bytes."""
    at, places = 0, {}
    for name, a in arrays.items():
        places[name] = [at, len(a), a.dtype.str]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(meta | {"arrays": places}).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    fs, where = pafs.FileSystem.from_uri(path)
    fs.create_dir(where.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(where, compression=None) as out:
        out.write(head)
        for a in arrays.values():
            out.write(a.tobytes())
            out.write(b"\0" * (-a.nbytes % 8))


@lru_cache(maxsize=64)
def read_arrays(path: str) -> tuple[dict, dict[str, np.ndarray]]:
    """Map a file of ``write_arrays``; where the store is not a file system, hold it in memory."""
    fs, where = pafs.FileSystem.from_uri(path)
    if isinstance(fs, pafs.LocalFileSystem):
        whole = np.memmap(where, dtype=np.uint8, mode="r").view(np.ndarray)
    else:
        with fs.open_input_file(where) as source:
            whole = np.frombuffer(source.read(), dtype=np.uint8)
    end = whole[: 1 << 16].tobytes().index(b"\n") + 1
    meta = json.load(io.BytesIO(whole[:end].tobytes()))
    return meta, {k: whole[end + at : end + at + n * np.dtype(t).itemsize].view(t) for k, (at, n, t) in meta["arrays"].items()}


def _sequence(meta: dict, arrays: dict, name: str) -> EliasFano:
    return EliasFano(*meta[name], *(arrays[f"{name}.{k}"] for k in range(3)))


def _store(meta: dict, arrays: dict, name: str, values: np.ndarray) -> None:
    meta[name], buffers = EliasFano.encode(values).buffers()
    arrays.update({f"{name}.{k}": b for k, b in enumerate(buffers)})


class Level:
    """The files of one level. rows: path, first key, nodes and tokens of each bucket, in order."""

    def __init__(self, number: int, rows: list[dict], patch: dict[int, float]):
        self.number, self.paths, self.patch = number, [r["path"] for r in rows], patch
        self.first = np.array([r["first_key"] for r in rows], dtype=np.int64).view(U64)
        self.base = np.concatenate([[0], np.cumsum([r["nodes"] for r in rows])]).astype(np.int64)
        self.tokens = np.concatenate([[0], np.cumsum([r["tokens"] for r in rows])]).astype(np.int64)

    @property
    def size(self) -> int:
        return int(self.base[-1])

    def _spans(self, bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
            if hi > lo and bucket[lo] >= 0:
                yield int(bucket[lo]), slice(int(lo), int(hi))

    def find(self, keys: np.ndarray, width: int, score: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: absent) and, for scores, discounted probability of the nodes with these sorted keys.

        ``width`` is the number of words. Where many successors are alike in their high bits, the context's pointers
        bound the search.
        """
        node, alpha = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys))
        if not self.paths or not len(keys):
            return node, alpha
        bucket = np.searchsorted(self.first, keys, side="right") - 1
        for b, span in self._spans(bucket):
            meta, arrays = read_arrays(self.paths[b])
            sequence = _sequence(meta, arrays, "successors")
            bound = None
            if self.number > 1:
                context, pointers = (keys[span] // U64(width)).astype(np.int64) - meta["c0"], _sequence(meta, arrays, "pointers")

                def bound(k, context=context, pointers=pointers):
                    c = np.minimum(context[k], pointers.n - 2)
                    return pointers.get(c).astype(np.int64), pointers.get(c + 1).astype(np.int64)

            at, hit = sequence.find(keys[span] - self.first[b], bound)
            part = node[span]
            part[hit] = at[hit] + self.base[b]
            node[span] = part
            if score and "alpha" in arrays:
                part = alpha[span]
                part[hit] = decode(arrays["alpha"][at[hit]])
                alpha[span] = part
        return node, alpha

    def counts(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens before, and tokens of, each of the sorted ``nodes`` (levels that keep counts)."""
        before, own = np.zeros(len(nodes), dtype=np.int64), np.zeros(len(nodes), dtype=np.int64)
        for b, span in self._spans(np.searchsorted(self.base, nodes, side="right") - 1):
            meta, arrays = read_arrays(self.paths[b])
            sums, at = _sequence(meta, arrays, "sums"), nodes[span] - self.base[b]
            start = sums.get(at).astype(np.int64)
            before[span], own[span] = start + self.tokens[b], sums.get(at + 1).astype(np.int64) - start
        return before, own

    def weights(self, contexts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Weight left to shorter contexts by each of the sorted nodes of the level below, and whether it has successors."""
        codes = np.zeros(len(contexts), dtype=np.uint16)
        out, parent = np.ones(len(contexts)), np.zeros(len(contexts), dtype=bool)
        if not self.paths or not len(contexts):
            return out, parent
        bucket = np.searchsorted(self.first, contexts.astype(U64) * U64(width) + U64(width - 1), side="right") - 1
        for b, span in self._spans(bucket):
            meta, arrays = read_arrays(self.paths[b])
            at = contexts[span] - meta["c0"]
            inside = (at >= 0) & (at < len(arrays["weights"]))
            part = codes[span]
            part[inside] = arrays["weights"][at[inside]]
            codes[span] = part
        out, parent = decode(codes), codes > 0
        for context, weight in self.patch.items():  # contexts at the edges of buckets
            k = int(np.searchsorted(contexts, context))
            if k < len(contexts) and contexts[k] == context:
                out[k], parent[k] = weight, True
        return out, parent


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and the offset of each text's first."""
    hashed, first = words.word_hashes(data, offsets)
    texts = len(first) - 1
    out = np.full(len(hashed) + texts, END, dtype=U64)
    owner = np.repeat(np.arange(texts), np.diff(first))
    out[np.arange(len(hashed)) + owner] = hashed
    return out, first + np.arange(texts + 1)


class Trie:
    def __init__(self, levels: list[Level], total: int):
        self.levels, self.total = levels, total

    @property
    def width(self) -> int:
        return self.levels[0].size

    def walk(self, hashed: np.ndarray, first: np.ndarray, upto: int, score: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of level ``upto`` that end at each token (-1: none), the words' ids and counts, log10 probabilities."""
        unique, inverse = np.unique(hashed, return_inverse=True)
        ids, _ = self.levels[0].find(unique, 0)
        count = np.zeros(len(unique), dtype=np.int64)
        known = np.flatnonzero(ids >= 0)
        count[known] = self.levels[0].counts(ids[known])[1]  # hashes are in order, and so are their ids
        word, count = ids[inverse], count[inverse]
        p = (count + 1.0) / (self.total + self.width + 1.0) if score else np.zeros(0)
        starts = np.zeros(len(hashed), dtype=bool)
        starts[first[:-1][first[:-1] < len(hashed)]] = True
        # the level's distinct nodes in order (-1: not in the trie), and which of them ends at each token (-1: none)
        nodes, place = ids, inverse
        for level in self.levels[1:upto]:
            before = np.concatenate([[-1], place[:-1]])
            before[starts] = -1
            context = np.where(before >= 0, nodes[before], -1)
            open_ = (context >= 0) & (word >= 0)
            if score:
                held = np.flatnonzero(nodes >= 0)
                weight, parent = np.ones(len(nodes)), np.zeros(len(nodes), dtype=bool)
                weight[held], parent[held] = level.weights(nodes[held], self.width)
                inside = np.flatnonzero(context >= 0)
                p[inside] *= weight[before[inside]]
                open_[inside] &= parent[before[inside]]
            both = np.flatnonzero(open_)
            keys, back = np.unique(context[both].astype(U64) * U64(self.width) + word[both].astype(U64), return_inverse=True)
            nodes, alpha = level.find(keys, self.width, score)
            place = np.full(len(hashed), -1, dtype=np.int64)
            place[both] = back
            if score:
                p[both] += alpha[back]
        return np.where(place >= 0, nodes[place], -1) if len(nodes) else place, word, count, np.log10(p) if score else p


def _count(docs: DataFrame, trie: Trie | None, number: int, buckets: int) -> DataFrame:
    """bucket, and compressed sorted keys and counts of the n-grams of each chunk of text."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for _, _, data, offsets in words.chunks(batch, "text", CHUNK):
                hashed, first = tokens(data, offsets)
                if number == 1:
                    keys, counts = np.unique(hashed, return_counts=True)
                    bucket = (keys >> U64(32)) * U64(buckets) >> U64(32)
                else:
                    node, word, _, _ = own.walk(hashed, first, number - 1, False)
                    context = np.concatenate([[-1], node[:-1]])
                    context[first[:-1][first[:-1] < len(hashed)]] = -1
                    both = context >= 0
                    keys, counts = np.unique(context[both].astype(U64) * U64(own.width) + word[both].astype(U64), return_counts=True)
                    context, word = (keys // U64(own.width)).astype(np.int64), (keys % U64(own.width)).astype(np.float64)
                    at = np.flatnonzero(np.diff(context, prepend=-1))  # contexts are in order
                    before, size = (np.repeat(x, np.diff([*at, len(context)])) for x in own.levels[number - 2].counts(context[at]))
                    place = before + size * (word / own.width)
                    bucket = np.minimum(place * (buckets / own.total), buckets - 1).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                out: dict[str, list] = {"bucket": [], "keys": [], "counts": []}
                for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                    if hi > lo:
                        for name, value in (("bucket", int(bucket[lo])), ("keys", _squeeze(keys[lo:hi])), ("counts", zstandard.compress(counts[lo:hi].astype(np.uint32).tobytes(), 1))):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=_COUNTED)

    return docs.select("text").mapInArrow(run, "bucket int, keys binary, counts binary")


_COUNTED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_MANIFEST = "bucket int, path string, first_key bigint, nodes bigint, tokens bigint, ends array<struct<context:bigint,total:bigint,kept:bigint,mass:bigint>>"


def _build(counted: DataFrame, trie: Trie | None, number: int, last: bool, cutoff: int, discount: float, where: str, buckets: int) -> DataFrame:
    """Merge each bucket's counts, one bucket in a task, and write its file; a manifest row for each."""
    shared = counted.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=_COUNTED)
        if not table.num_rows:
            return
        own, bucket = shared.value, table["bucket"][0].as_py()
        keys = np.concatenate([_spread(b.as_py()) for b in table["keys"]])
        counts = np.concatenate([np.frombuffer(zstandard.decompress(b.as_py()), dtype=np.uint32) for b in table["counts"]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[begins], np.add.reduceat(counts.astype(np.int64), begins)
        meta: dict = {}
        arrays: dict[str, np.ndarray] = {}
        ends: list[dict] = []
        n_tokens = int(counts.sum())
        first_key = keys[0]
        if number > 1:
            width = U64(own.width)
            context = (keys // width).astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total = np.add.reduceat(counts, at)
            edge = np.unique([context[0], context[-1]])  # these may lie in other buckets too
            total[np.searchsorted(context[at], edge)] = own.levels[number - 2].counts(edge)[1]
            kept = counts >= cutoff
            mass = np.add.reduceat(np.where(kept, counts, 0), at)
            number_kept = np.add.reduceat(kept.astype(np.int64), at)
            c0, c1 = int(context[0]), int(context[-1])
            weights = np.zeros(c1 - c0 + 1, dtype=np.uint16)
            # 0 marks a context none of whose n-grams is kept
            weights[context[at] - c0] = np.where(number_kept > 0, np.maximum(code((total - mass + discount * number_kept) / total), 1), 0)
            ends = [{"context": int(c), "total": int(total[k]), "kept": int(number_kept[k]), "mass": int(mass[k])} for c in edge for k in [int(np.searchsorted(context[at], c))]]
            spans = np.repeat(total, np.diff([*at, len(keys)]))
            arrays |= {"weights": weights, "alpha": code((counts[kept] - discount) / spans[kept])}
            meta["c0"] = c0
            of = np.zeros(c1 - c0 + 2, dtype=np.int64)
            of[1:] = np.cumsum(np.bincount(context[kept] - c0, minlength=c1 - c0 + 1))
            _store(meta, arrays, "pointers", of)
            keys, counts = keys[kept], counts[kept]
        _store(meta, arrays, "successors", keys - first_key)
        if not last:
            _store(meta, arrays, "sums", np.concatenate([[0], np.cumsum(counts)]))
        path = f"{where}/level{number}-{bucket:06d}-{TaskContext.get().taskAttemptId()}.trie"
        write_arrays(path, meta, arrays)
        row = {"bucket": bucket, "path": path, "first_key": int(np.array([first_key], dtype=U64).view(np.int64)[0]), "nodes": len(keys), "tokens": n_tokens, "ends": ends}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("bucket", pa.int32()), ("path", pa.string()), ("first_key", pa.int64()), ("nodes", pa.int64()), ("tokens", pa.int64()), ("ends", pa.list_(pa.struct([(k, pa.int64()) for k in ("context", "total", "kept", "mass")])))]))

    return counted.repartitionById(buckets, "bucket").mapInArrow(run, _MANIFEST)


def train(docs: DataFrame, order: int = ORDER, cutoffs: tuple[int, ...] = CUTOFFS, discounts: tuple[float, ...] = DISCOUNTS, bucket_tokens: int = BUCKET_TOKENS) -> Trie:
    """Count all n-grams of the texts of ``docs``, level by level, and write the trie to the shared folder.

    Cutoffs of all levels but the last are 1, so that every context has its node.
    """
    spark = docs.sparkSession
    if any(c != 1 for c in cutoffs[: order - 1]):
        raise ValueError("only the last level may leave n-grams out")
    where = scratch.folder(spark, "trie")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // (6 * bucket_tokens))
    trie: Trie | None = None
    for number in range(1, order + 1):
        counted = _count(docs, trie, number, buckets)
        manifest = _build(counted, trie, number, number == order, cutoffs[number - 1], discounts[number - 1], where, buckets)
        rows = sorted((r.asDict(recursive=True) for r in manifest.collect()), key=lambda r: r["bucket"])  # one for each bucket
        parts: dict[int, list[dict]] = {}
        for r in rows:
            for e in r["ends"]:
                parts.setdefault(e["context"], []).append(e)
        patch = {c: float(decode(code(np.array([(e[0]["total"] - sum(x["mass"] for x in e) + discounts[number - 1] * sum(x["kept"] for x in e)) / e[0]["total"]])))[0]) for c, e in parts.items() if len(e) > 1}
        level = Level(number, rows, patch)
        if trie is None:
            trie = Trie([level], int(level.tokens[-1]))
        else:
            trie.levels.append(level)
        if level.size * max(trie.width, 1) >= 1 << 63:
            raise ValueError("keys of this corpus do not fit 63 bits: use a lower order")
        if not level.size:
            break
    return trie


def fold(doc_id: str = "doc_id"):
    """Whether a document is held out; one without an id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)  # paths and a few numbers for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for start, stop, data, offsets in words.chunks(batch, "text", CHUNK):
                hashed, first = tokens(data, offsets)
                _, _, count, p = own.walk(hashed, first, len(own.levels), True)
                base = np.log10((count + 1.0) / (own.total + own.width + 1.0))
                sums = [np.add.reduceat(v, first[:-1]) for v in ((count > 0).astype(np.int64), base, p)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *map(pa.array, (np.diff(first), *sums))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(docs: DataFrame, order: int = ORDER, cutoffs: tuple[int, ...] = CUTOFFS, discounts: tuple[float, ...] = DISCOUNTS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    A null or empty text has one token, its end. Rows with a null doc_id are trained on; repeated rows count and are
    scored each. An empty table gives an empty result; without training rows every token is unknown. Only doc_id and
    text are read.
    """
    trie = train(docs.where(~fold()).select(F.coalesce("text", F.lit("")).alias("text")), order, cutoffs, discounts, bucket_tokens)
    scored = score(docs, trie)
    return scored.select("doc_id", fold().alias("held_out"), "n_tokens", "n_known", F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")
