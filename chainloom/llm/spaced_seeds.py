"""Benchmark passages in documents: spaced seeds, then a check that allows substituted words.

A mask fixes which words of a window are hashed; the others may differ. Windows of benchmark items and of documents
with equal hashes under a mask give hits, and the two texts are compared word by word along the whole diagonal of each
hit. An item of fewer words than the shortest mask is a seed as a whole and has to occur as it is. The benchmark is
worked off in blocks of bounded size, each against all documents in a job of its own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chainloom.llm import scratch, words

#: Fixed masks: 1 is hashed, 0 is ignored. Together they hit every overlap that ``passes`` accepts, wherever its
#: substitutions lie (the tests count them out).
MASKS = ("1110110111", "1101110100111", "111111", "1100111001011", "11101011", "1110001011", "1001101011", "101011011", "1100111001")
#: Items of fewer words are hashed whole.
SHORT_ITEM = 6
#: Words of the benchmark held by a task at once.
BLOCK_WORDS = 1 << 20
#: An overlap has so many equal words at least, or all but one in ten of a shorter item's, in a stretch of which at
#: least this share is equal.
LEAST_EQUAL, LEAST_SHARE = 13, 0.75
#: Pairs of a document's and the benchmark's windows, and words along diagonals, that are looked at together.
PAIRS = 1 << 20
#: Texts up to which the marks of contaminated ones (16 bytes each) may be broadcast.
BROADCAST_TEXTS = 1_000_000
_FILTER_BITS = 24


class Block:
    """Some benchmark items: their words, and the hash of every window under every mask."""

    def __init__(self, items: list[tuple[object, np.ndarray]], masks: tuple[str, ...] = MASKS):
        self.ids = [i for i, _ in items]
        sizes = np.array([len(w) for _, w in items], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.words = np.concatenate([w for _, w in items]) if items else np.zeros(0, dtype=np.uint64)
        self.need = np.minimum(LEAST_EQUAL, -(-sizes * 9 // 10))
        # masks with their numbers; a short item's mask is its length, and its number tells it from those of windows
        self.masks = [*enumerate(masks), *((100 + n, "1" * n) for n in sorted({*sizes.tolist()}) if 0 < n < SHORT_ITEM)]
        owner = np.repeat(np.arange(len(items)), sizes)
        hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for number, mask in self.masks:
            h, at = seeds(self.words, self.first, mask, number)
            whole = sizes[owner[at]]
            keep = whole == len(mask) if number >= 100 else whole >= SHORT_ITEM
            hashes.append(h[keep])
            places.append(at[keep])
        hashes, places = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], places[order]
        self.owners = owner[self.places]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True


def seeds(hashed: np.ndarray, first: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows under a mask that lie within one text, and where each window begins."""
    span = len(mask)
    if len(hashed) < span:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    n = len(hashed) - span + 1
    total = np.full(n, number + 1, dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += hashed[k : k + n] * words.STEPS[k]
    ends = np.repeat(first[1:], np.diff(first))
    at = np.arange(n)
    inside = at + span <= ends[:n]
    return words.mix(total[inside]), at[inside]


def overlaps(a: np.ndarray, b: np.ndarray, shift: int) -> set[tuple[int, int, int]]:
    """Best stretches where a[i] meets b[i + shift]: begin and end in ``b`` and equal words.

    A stretch scores 1 for an equal and -2 for a different word. The best one through each word is taken, so that the
    result does not depend on which of them a seed has hit.
    """
    low, high = max(0, -shift), min(len(a), len(b) - shift)
    same = a[low:high] == b[low + shift : high + shift]
    if not same.any():
        return set()
    n = len(same)
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    before, equal = sums[:-1], np.concatenate([[0], np.cumsum(same)])
    # of all begins up to a word the last with the smallest sum before it, of all ends from it on the first with the largest
    lowest = np.minimum.accumulate(before)
    start = np.maximum.accumulate(np.where(before == lowest, np.arange(n), 0))
    backward = sums[1:][::-1]
    highest = np.maximum.accumulate(backward)
    stop = n - np.maximum.accumulate(np.where(backward == highest, np.arange(n), 0))[::-1]
    pairs = np.unique(np.stack([start[same], stop[same]], axis=1), axis=0).tolist()
    return {(low + shift + x, low + shift + y, int(equal[y] - equal[x])) for x, y in pairs}


def passes(length: int, equal: int, item: int) -> bool:
    need = min(LEAST_EQUAL, -(-item * 9 // 10))
    return equal >= need and equal >= LEAST_SHARE * length


def _hits(block: Block, hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in texts, in order, whose window under some mask the block holds, and the range of its equal hashes."""
    at, low, high = [], [], []
    for number, mask in block.masks:
        h, place = seeds(hashed, first, mask, number)
        hit = np.flatnonzero(block.filter[h >> np.uint64(64 - _FILTER_BITS)])
        x, y = np.searchsorted(block.hashes, h[hit], "left"), np.searchsorted(block.hashes, h[hit], "right")
        true = y > x
        at.append(place[hit][true])
        low.append(x[true])
        high.append(y[true])
    at, low, high = map(np.concatenate, (at, low, high))
    order = np.argsort(at, kind="stable")
    return at[order], low[order], high[order]


def _diagonals(block: Block, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Items and shifts of the diagonals on which a document has hits, some windows of the document at a time."""
    at, low, high = hits
    n = high - low
    before = np.concatenate([[0], np.cumsum(n)])
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS, "right")) - 1)
        size = n[start:stop]
        k = np.repeat(low[start:stop] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        item = block.owners[k]
        shift = np.repeat(at[start:stop], size) - (block.places[k] - block.first[item])
        # an item is far shorter than 2^31 words, so that a shift is its place in the document, moved to be positive
        key = np.unique((item << np.int64(40)) + (shift + np.int64(1 << 31)))
        yield key >> np.int64(40), (key & np.int64((1 << 40) - 1)) - np.int64(1 << 31)
        start = stop


def matches(block: Block, hashed: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> dict[int, tuple[int, int, int]]:
    """Items that overlap one document's words: place in block -> (begin, end, equal words) of the overlap with the most
    equal words, the first one of equals."""
    found: dict[int, tuple[int, int, int]] = {}
    for items, shifts in _diagonals(block, _hits(block, hashed, np.array([0, len(hashed)])) if hits is None else hits):
        low = np.maximum(0, -shifts)
        size = np.minimum(np.diff(block.first)[items], len(hashed) - shifts) - low
        ends = np.cumsum(size)
        start = 0
        while start < len(items):  # equal words of each diagonal, for some diagonals at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
            some = slice(start, stop)
            begin = np.cumsum(size[some]) - size[some]
            step = np.arange(size[some].sum()) - np.repeat(begin, size[some])
            own = block.words[np.repeat((block.first[items] + low)[some], size[some]) + step]
            equal = np.add.reduceat((own == hashed[np.repeat((low + shifts)[some], size[some]) + step]).astype(np.int64), begin)
            good = np.flatnonzero(equal >= block.need[items[some]])
            for k in (good[np.lexsort((shifts[some][good], -equal[good]))] + start).tolist():
                item, shift = int(items[k]), int(shifts[k])
                best = found.get(item, (0, 0, 0))
                if (-int(equal[k - start]), max(0, shift)) > (-best[2], best[0]):
                    continue  # neither more equal words nor an earlier begin
                own_words = block.words[block.first[item] : block.first[item + 1]]
                for x, y, n in sorted(overlaps(own_words, hashed, shift)):
                    if passes(y - x, n, len(own_words)) and (-n, x, y) < (-best[2], best[0], best[1]):
                        best = found[item] = (x, y, n)
            start = stop
    return found


def blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS, nameless: bool = False) -> Iterator[Block]:
    """The benchmark in blocks of at most ``limit`` words, or one item where it alone is longer. Items without an id
    are among them if asked for."""
    held: list[tuple[object, np.ndarray]] = []
    size = 0
    items = benchmark.select("item_id", "text").where("text is not null").where(F.lit(nameless) | F.col("item_id").isNotNull())
    for row in items.toLocalIterator(prefetchPartitions=False):
        data = np.frombuffer(row["text"].encode(), dtype=np.uint8)
        hashed, _ = words.word_hashes(data, np.array([0, len(data)]))
        if not len(hashed):
            continue
        if held and size + len(hashed) > limit:
            yield Block(held)
            held, size = [], 0
        held.append((row["item_id"], hashed))
        size += len(hashed)
    if held:
        yield Block(held)


def _hits_of_batch(block: Block, batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Row, item place, begin, end, equal words and item words of each overlap."""
    for start, _, data, offsets in words.chunks(batch, column):
        hashed, first = words.word_hashes(data, offsets)
        at, low, high = _hits(block, hashed, first)
        cuts = np.searchsorted(at, first)
        for row in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[row], cuts[row + 1])
            hits = at[own] - first[row], low[own], high[own]
            for item, (begin, end, equal) in matches(block, hashed[first[row] : first[row + 1]], hits).items():
                yield start + row, item, begin, end, equal, int(block.first[item + 1] - block.first[item])


def _each(spark: SparkSession, found: Iterator[Block], job, name: str) -> list[DataFrame]:
    """``job`` over each block. Of several blocks one is broadcast at a time, and what its job gives is kept."""
    block, out = next(found, None), []
    while block is not None:
        following, shared = next(found, None), spark.sparkContext.broadcast(block)
        part = job(shared)
        if following is not None or out:
            part = scratch.keep(part, name)
            shared.destroy()
        out.append(part)
        block = following
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, first_word, last_word, equal_words, item_words: the best overlap of each document and item.

    An item of fewer than ten words has to occur as it is. Items without words or id are left out; of items with one id
    each counts alone. Null and empty documents overlap nothing; a text of any length is searched whole. Repeated rows
    give their overlaps each. An empty benchmark or table gives an empty result. Only doc_id and text of ``docs`` are
    read, and ids may be of any type.
    """
    spark: SparkSession = docs.sparkSession
    scratch.ship(spark)
    item_type = benchmark.schema["item_id"].dataType
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {item_type.simpleString()}, first_word bigint, last_word bigint, equal_words bigint, item_words bigint"
    read, arrow = docs.select("doc_id", "text"), to_arrow_type(item_type)

    def job(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                rows = list(_hits_of_batch(block, batch, "text"))
                if rows:
                    row, item, begin, end, equal, size = map(np.array, zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array([block.ids[i] for i in item.tolist()], type=arrow), *(pa.array(x.astype(np.int64)) for x in (begin, end - 1, equal, size))], names=["doc_id", "item_id", "first_word", "last_word", "equal_words", "item_words"])

        return read.mapInArrow(run, schema)

    out = None
    for part in _each(spark, blocks(benchmark, block_words), job, "overlaps"):
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns.

    Nulls, short items, texts of any length, repeated rows and empty tables are treated as by ``find_overlaps``, but for
    items without an id, which count here: rows without text stay, and repeated rows go or stay together. Where the benchmark takes several blocks, each marks the
    texts that it is found in (by 128 bits), and rows with a marked text go at the end.
    """
    spark: SparkSession = docs.sparkSession
    scratch.ship(spark)
    columns = docs.columns
    names = [f"c{k}" for k in range(len(columns))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)))
    text = names[columns.index("text")]
    found = blocks(benchmark, block_words, nameless=True)
    head = list(itertools.islice(found, 2))

    def dirty(block: Block, batch: pa.RecordBatch, column: str) -> np.ndarray:
        out = np.zeros(batch.num_rows, dtype=bool)
        for row, *_ in _hits_of_batch(block, batch, column):
            out[row] = True
        return out

    def clean(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(~dirty(shared.value, batch, text)))

        return plain.mapInArrow(run, plain.schema)

    marks = [F.xxhash64(text).alias("mark0"), F.xxhash64(F.lit(1), text).alias("mark1")]

    def marked(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(dirty(shared.value, batch, text))).select(["mark0", "mark1"])

        return plain.select(text, *marks).mapInArrow(run, "mark0 bigint, mark1 bigint").distinct()

    if not head:
        return docs
    if len(head) == 1:
        (out,) = _each(spark, iter(head), clean, "clean")
    else:
        several = None
        for part in _each(spark, itertools.chain(head, found), marked, "contaminated"):
            several = part if several is None else several.unionByName(part)
        several = scratch.keep(several.distinct(), "contaminated")
        several = F.broadcast(several) if several.count() <= BROADCAST_TEXTS else several
        out = plain.select("*", *marks).join(several, ["mark0", "mark1"], "left_anti")
    return out.select(*(F.col(n).alias(c) for c, n in zip(columns, names, strict=True)))
