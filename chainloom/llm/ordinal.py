"""Quality by ordinal regression: a cumulative-link model over hashed text.

P(grade <= k) = sigmoid(threshold_k - w.x): all thresholds share the weights w of the hashed words and shapes of a
text, and are kept in order. Training uses a bounded sample of rated documents; scoring reads every whole document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch, words

#: Bound of the training sample, in documents of any length.
SAMPLE_DOCUMENTS = 12_000
#: A feature must lie in so many sampled documents, with a grade's share there so many standard errors from its share
#: in all; features are hashed to this many bits.
LEAST_DOCUMENTS, LEAST_SIGNAL, HASH_BITS = 3, 5.0, 26
#: Probability of the best grade below which a document is rejected.
LEAST_TAIL = 0.5
_SHAPE_SALT = np.uint64(0x5851F42D4C957F2D)
_NUMBERS = 9  # numeric features beside the hashed ones


@dataclass(frozen=True)
class Ordinal:
    """keys: sorted hashed features; weights: theirs, then those of the numeric features; thresholds: ascending."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def grades(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 good. Labels with a null and repeated ones count as the lowest."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.coalesce("quality", F.lit(0)) == 1, 2).otherwise(1)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(grade).cast("int").alias("grade"))


def _shape_table() -> np.ndarray:
    """Bytes by class: lower case and non-ASCII a, upper case A, digits 0, the rest themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123] = 97
    table[128:] = 97
    table[65:91] = 65
    table[48:58] = 48
    return table


_SHAPE = _shape_table()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words and shapes of each text (values, offset of each text's first) and its numeric features."""
    starts, ends, first = words.bounds(data, offsets)
    plain = words.hash_words(data, starts, ends)
    n = np.diff(first).astype(np.float64)
    texts = len(n)
    owner = np.repeat(np.arange(texts), np.diff(first))
    # letters only, so that "word," and "WORD!!" count as the word
    letter = (_SHAPE[data] == 97) | (_SHAPE[data] == 65)
    kept = np.concatenate([[0], np.cumsum(letter)])
    inner = np.flatnonzero(letter)
    bare_starts, bare_ends = kept[starts], kept[ends]
    bare = words.hash_words(data[inner], bare_starts, bare_ends)
    # the shape of a word: classes of its bytes with runs cut to one
    shape = _SHAPE[data]
    change = np.ones(len(shape), dtype=bool)
    change[1:] = shape[1:] != shape[:-1]
    change[starts] = True
    run = np.concatenate([[0], np.cumsum(change)])
    kinds = words.hash_words(shape[np.flatnonzero(change)], run[starts], run[ends], lower=False) ^ _SHAPE_SALT
    values = np.concatenate([bare[bare_ends > bare_starts], kinds]) >> np.uint64(64 - HASH_BITS)
    owners = np.concatenate([owner[bare_ends > bare_starts], owner])
    distinct, at = words.distinct_per_text(values, owners, texts)
    safe = np.maximum(n, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=mask.astype(np.float64), minlength=texts) / safe

    upper = np.concatenate([[0], np.cumsum(shape == 65)])
    sign = np.concatenate([[0], np.cumsum((shape != 97) & (shape != 65) & (shape != 48))])
    length = ends - starts
    marks = sign[ends] - sign[starts]
    _, first_of = words.distinct_per_text(plain, owner, texts)
    repeated = 1 - np.diff(first_of) / safe
    same = np.zeros(len(plain), dtype=bool)
    same[1:] = (plain[1:] == plain[:-1]) & (owner[1:] == owner[:-1])
    columns = [share((upper[ends] - upper[starts]) * 2 > length), share(marks >= 2), share(marks == length), share(same), share(length > 20), np.where(n > 50, repeated, 0.0), np.where((n > 50) & (repeated > 0.8), 1.0, 0.0), np.where(n == 0, 1.0, 0.0), np.ones(texts)]
    return distinct, at, np.stack(columns, axis=1).astype(np.float64)


def informative(sample: DataFrame) -> np.ndarray:
    """Sorted features of a sample (grade, hashed) that are associated with a grade.

    Spark counts the documents of each feature; the features chosen, of at most 2^HASH_BITS, come to the driver.
    """
    n, *of_grade = sample.agg(F.count(F.lit(1)), *(F.sum((F.col("grade") == k).cast("long")) for k in (0, 1))).first()
    if not n:
        return np.zeros(0, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grade = batch.column(0).to_numpy()
            lists = [np.frombuffer(v.as_buffer(), dtype=np.uint32) for v in batch.column(1)]
            keys, index, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *lists]), return_inverse=True, return_counts=True)
            owner = np.repeat(grade, [len(v) for v in lists])
            by = [np.bincount(index, weights=owner == k, minlength=len(keys)).astype(np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (keys.astype(np.int64), counts, *by))), names=["feature", "n", "n0", "n1"])

    counted = sample.select("grade", "hashed").mapInArrow(run, "feature bigint, n bigint, n0 bigint, n1 bigint").groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("n", "n0", "n1")))
    signal = F.lit(False)
    for k in (0, 1):  # how far the share of a grade among a feature's documents is from its share in all
        mean = of_grade[k] / n
        signal |= F.abs(F.col(f"n{k}") - F.col("n") * mean) / F.sqrt(F.col("n") * max(mean * (1 - mean), 1e-9)) >= LEAST_SIGNAL
    chosen = counted.where((F.col("n") >= min(LEAST_DOCUMENTS, max(1, n // 50))) & signal).select("feature").toArrow()
    return np.sort(chosen["feature"].to_numpy().astype(np.uint32))


def fit(rows: Iterator[tuple[int, bytes, bytes]], keys: np.ndarray | None = None, rounds: int = 120, rate: float = 0.15, ridge: float = 2e-4) -> Ordinal:
    """Fit by full-batch adaptive gradient steps. rows: grade, features (uint32) among the sorted ``keys``, numeric
    features (float64)."""
    graded = list(rows)
    if not graded:
        return Ordinal(np.zeros(0, dtype=np.uint32), np.zeros(_NUMBERS), np.array([-20.0, -10.0]))
    keys = np.zeros(0, dtype=np.uint32) if keys is None else keys
    y = np.array([g for g, _, _ in graded])
    lists = [np.frombuffer(v, dtype=np.uint32) for _, v, _ in graded]
    numbers = np.stack([np.frombuffer(v, dtype=np.float64) for _, _, v in graded])
    column = np.searchsorted(keys, np.concatenate(lists))
    row = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
    weights, grid = np.zeros(len(keys) + _NUMBERS), np.array([-2.0, np.log(3.0)])
    classes = np.bincount(y, minlength=3).astype(np.float64)
    balance = (len(y) / (3 * np.maximum(classes, 1)))[y] ** 0.5
    moment, moment_t = np.zeros_like(weights), np.zeros(2)
    square, square_t = np.zeros_like(weights), np.zeros(2)
    for step in range(1, rounds + 1):
        score = np.bincount(row, weights=weights[column], minlength=len(y)) + numbers @ weights[len(keys) :]
        thresholds = np.array([grid[0], grid[0] + np.exp(grid[1])])
        edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
        low, high = (1 / (1 + np.exp(-np.clip(edge[y + k] - score, -40, 40))) for k in (0, 1))
        low[y == 0], high[y == 2] = 0.0, 1.0
        mass = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        d_score = balance * (d_high - d_low) / mass / len(y)  # of the loss -log(mass)
        d_edges = np.zeros(2)
        for k in (0, 1):
            d_edges[k] = -(balance * d_high / mass)[y == k].sum() / len(y) + (balance * d_low / mass)[y == k + 1].sum() / len(y)
        grad = np.concatenate([np.bincount(column, weights=d_score[row], minlength=len(keys)), numbers.T @ d_score]) + ridge * weights / 10
        grad_t = np.array([d_edges.sum(), d_edges[1] * np.exp(grid[1])])
        for value, g, m, s in ((weights, grad, moment, square), (grid, grad_t, moment_t, square_t)):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        weights[: len(keys)] *= 1 - ridge
    return Ordinal(keys, weights, np.array([grid[0], grid[0] + np.exp(grid[1])]))


def _featurise(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for start, stop, data, offsets in words.chunks(batch, column):
        yield start, stop, *features(data, offsets)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Ordinal:
    """Fit on at most ``sample`` rated documents of any length, those with the smallest hash of doc_id. Rated documents
    without a text are not learnt from; of rows that repeat a doc_id, one text is.

    The driver gets the chosen features that each of them has, not its text.
    """
    scratch.ship(docs.sparkSession)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).where("text is not null")
    of_each = texts.groupBy("doc_id").agg(F.min("hash").alias("hash"))
    chosen = of_each.join(grades(labels), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, values, at, numbers in _featurise(batch, "text"):
                lists = [values[at[k] : at[k + 1]].astype(np.uint32).tobytes() for k in range(stop - start)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(lists, type=pa.binary()), pa.array([n.tobytes() for n in numbers], type=pa.binary())], names=["grade", "hashed", "numbers"])

    # the sample's ids, grades and hashes are bounded by ``sample`` rows of 20 bytes
    rated = texts.join(F.broadcast(chosen), ["doc_id", "hash"]).groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("grade", "text")
    found = scratch.keep(rated.mapInArrow(run, "grade int, hashed binary, numbers binary"), "rated")
    keys = informative(found)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(v.as_buffer(), dtype=np.uint32) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v[np.isin(v, keys)].tobytes() for v in lists], type=pa.binary()), batch.column(2)], names=batch.schema.names)

    kept = found.mapInArrow(narrow, found.schema)
    return fit(((r["grade"], bytes(r["hashed"]), bytes(r["numbers"])) for r in kept.toLocalIterator()), keys)


def score(docs: DataFrame, model: Ordinal, carry: list[str]) -> DataFrame:
    """Columns ``carry`` of ``docs`` with expected_grade, p_above_toxic and p_good of each whole text."""
    scratch.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for start, stop, values, at, numbers in _featurise(batch, "text__"):
                total = numbers @ own.weights[len(own.keys) :]
                if len(own.keys):
                    place = np.minimum(np.searchsorted(own.keys, values.astype(np.uint32)), len(own.keys) - 1)
                    gain = np.where(own.keys[place] == values, own.weights[place], 0.0)
                    sums = np.concatenate([[0.0], np.cumsum(gain)])
                    total = total + sums[at[1:]] - sums[at[:-1]]
                tails = own.tails(total)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, stop - start) for k in range(len(carry))), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 1])], names=[*carry, "expected_grade", "p_above_toxic", "p_good"])

    read = docs.select(*carry, F.col("text").alias("text__"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{schema}, expected_grade double, p_above_toxic double, p_good double")


def accepted(least_tail: float = LEAST_TAIL) -> Column:
    return F.col("p_good") >= least_tail


def classify(docs: DataFrame, labels: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """doc_id, expected_grade, p_above_toxic, p_good and kept for every row of ``docs``.

    A null text is scored as an empty one, a text of any length as a whole, repeated rows each for itself; rows with a
    null doc_id are scored but never trained on. Without any usable label everything is kept. An empty table gives an
    empty result; other columns are not read.
    """
    model = train(docs, labels)
    return score(docs, model, ["doc_id"]).withColumn("kept", accepted(least_tail))


def reject(docs: DataFrame, labels: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns; each text passes through one task once.

    Nulls, repeated rows, texts of any length and empty tables are treated as by ``classify``: repeated rows are kept or
    rejected together, and other columns, whatever their names, come back as they were.
    """
    columns = docs.columns
    names = [f"c{k}" for k in range(len(columns))]  # names of the model's own columns cannot clash with these
    model = train(docs, labels)
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)), F.col("text"))
    return score(plain, model, names).where(accepted(least_tail)).select(*(F.col(n).alias(c) for c, n in zip(columns, names, strict=True)))
