"""Language by cross-parsing: the language in whose sample a text falls into the fewest phrases.

A text is read from the left in phrases, each the longest run of bytes that occurs somewhere in a language's sample of
labelled text; a suffix automaton of that sample finds where each phrase ends. The number of phrases times the bits that
it takes to point into the sample, over the length of the text, estimates the cross-entropy of the text against the
language. Samples are bounded; every byte of every text is parsed against every language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm import scratch, words

#: Bounds of what is learnt from, in bytes: of all languages, of one language, of one text.
SAMPLE_BYTES, LANGUAGE_BYTES, TEXT_BYTES = 8 << 20, 128 << 10, 1 << 10
#: A phrase also ends at each multiple of so many bytes of a text, so that parts of a long text are parsed side by side.
SEGMENT = 512
#: Bytes of text parsed together.
CHUNK = 4 << 20
UNKNOWN = "und"
_EMPTY = np.uint32(0xFFFFFFFF)
_SPREAD = 2654435769


def letters(text: Column) -> Column:
    """Lower-case letters and marks of a text, with one space for each run of anything else."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def suffix_automaton(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of ``text``: keys (state * 256 + byte) and the states that they lead to.

    State 0 is the start; a run of bytes leads from it to a state if and only if it occurs in the text.
    """
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    sizes = np.array([len(s) for s in step])
    states = np.repeat(np.arange(len(step), dtype=np.uint32), sizes)
    symbols = np.fromiter((c for s in step for c in s), dtype=np.uint32, count=sizes.sum())
    return states << np.uint32(8) | symbols, np.fromiter((t for s in step for t in s.values()), dtype=np.uint32, count=sizes.sum())


@dataclass(frozen=True)
class Automaton:
    """Transitions in a hash table of two halves, each of which has one place for a key: the key above and its state below
    (cuckoo hashing), so that each is found, or not, in two looks. ``start``: states by first byte."""

    lang: str
    sample: int
    bits: int
    factors: tuple[int, int]
    table: np.ndarray
    start: np.ndarray

    def _place(self, key: np.ndarray, half: int) -> np.ndarray:
        return ((key * np.uint32(self.factors[half])) >> np.uint32(32 - self.bits)).astype(np.intp) + (half << self.bits)

    @staticmethod
    def of(lang: str, sample: int, keys: np.ndarray, states: np.ndarray) -> Automaton:
        bits, factor = max(4, (len(keys) + len(keys) // 4).bit_length()), _SPREAD
        start = np.full(256, _EMPTY, dtype=np.uint32)
        start[keys[keys < 256]] = states[keys < 256]
        while True:
            factors = (factor, factor * 0x85EBCA6B & 0xFFFFFFFF)
            own = Automaton(lang, sample, bits, factors, np.full(2 << bits, _EMPTY.astype(np.uint64) << np.uint64(32), dtype=np.uint64), start)
            left, half = keys.astype(np.uint64) << np.uint64(32) | states, 0
            for _ in range(200):
                if not len(left):
                    return own
                # what was there before, and what lost a place to another, goes to its place in the other half
                place = own._place((left >> np.uint64(32)).astype(np.uint32), half)
                places = np.unique(place)
                before = own.table[places]
                own.table[place] = left
                lost = left[own.table[place] != left]
                left = np.concatenate([before[before >> np.uint64(32) != _EMPTY], lost])
                half = 1 - half
            factor = factor * 0xC2B2AE35 & 0xFFFFFFFF  # keys that chase each other in a ring: other places

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state of each, and the places of those that have none, as where the state is ``_EMPTY``."""
        key = (state << np.uint32(8)) | symbol
        found = self.table.take(self._place(key, 0), mode="clip").view(np.uint32).reshape(-1, 2)  # state and key of each
        after, missed = found[:, 0], np.flatnonzero(found[:, 1] != key)
        key = key[missed]
        more = self.table.take(self._place(key, 1), mode="clip").view(np.uint32).reshape(-1, 2)
        hit = more[:, 1] == key
        after[missed[hit]] = more[hit, 0]
        return after, missed[~hit]

    def phrases(self, columns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of phrases of each segment. ``columns[t, i]`` is byte t of segment i; segments come longest first."""
        count = np.zeros(len(lengths), dtype=np.int64)
        alive = np.searchsorted(-lengths, -np.arange(len(columns)), side="left")  # segments with more than t bytes
        state = np.full(len(lengths), _EMPTY, dtype=np.uint32)  # nothing goes on from here
        for t, n in enumerate(alive):
            symbol = columns[t, :n].astype(np.uint32)
            state, ended = self.follow(state[:n], symbol)
            count[ended] += 1
            state[ended] = self.start[symbol[ended]]  # a byte that the sample lacks is a phrase of its own
        return count


def segments(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut in segments, longest first: their bytes by columns, lengths, and the text that each belongs to."""
    long = np.diff(offsets)
    n = -(-long // size)
    owner = np.repeat(np.arange(len(long)), n)
    at = offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * size
    lengths = np.minimum(size, offsets[1:][owner] - at)
    order = np.argsort(-lengths, kind="stable")
    owner, at, lengths = owner[order], at[order], lengths[order]
    columns = np.zeros((int(lengths[0]) if len(lengths) else 0, len(lengths)), dtype=np.uint8)
    for t in range(len(columns)):
        alive = int(np.searchsorted(-lengths, -t, side="left"))
        columns[t, :alive] = data[at[:alive] + t]
    return columns, lengths, owner


def sample(rows: DataFrame, total: int = SAMPLE_BYTES, most: int = LANGUAGE_BYTES, of_text: int = TEXT_BYTES) -> DataFrame:
    """lang, piece and draw: the letters of the beginnings of texts (lang, text), each once, those with the smallest
    hash, within the bounds."""
    begin = letters(F.substring("text", 1, of_text))
    pieces = rows.where("lang is not null and text is not null").select("lang", begin.alias("piece")).where("piece <> ''")
    pieces = pieces.withColumn("draw", F.xxhash64("piece"))
    # copies count once here too: one number for each different piece
    sizes = pieces.groupBy("lang", "draw").agg(F.max(F.octet_length("piece")).alias("bytes")).groupBy("lang").agg(F.sum("bytes").alias("bytes"))
    share = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(total) / F.greatest(F.lit(1), F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))))))
    bounds = sizes.select("lang", share.alias("most"), (F.lit(float(1 << 63)) * (8.0 * share / F.col("bytes") - 1.0)).alias("below"))
    # four times what is needed; then the exact bound
    drawn = pieces.join(bounds, "lang").where(F.col("draw") <= F.col("below")).select("lang", "piece", "draw", "most").distinct()
    order = Window.partitionBy("lang").orderBy("draw", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("piece")).over(order), F.lit(0))
    return drawn.withColumn("before", before).where("before < most").select("lang", "piece", "draw")


def train(rows: DataFrame, **bounds: int) -> list[Automaton]:
    """The automaton of each language of rows (lang, text), in the order of their names. Each is built in a task."""

    def build(lang: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        text = " ".join(pieces.sort_values(["draw", "piece"])["piece"]).encode()
        keys, states = suffix_automaton(text)
        return pd.DataFrame({"lang": [lang[0]], "sample": [len(text)], "keys": [keys.tobytes()], "states": [states.tobytes()]})

    built = sample(rows, **bounds).groupBy("lang").applyInPandas(build, "lang string, sample long, keys binary, states binary")
    # bounded by SAMPLE_BYTES, of which each byte gives at most three transitions of eight bytes
    return [Automaton.of(r["lang"], r["sample"], np.frombuffer(r["keys"], np.uint32), np.frombuffer(r["states"], np.uint32)) for r in sorted(built.collect(), key=lambda r: r["lang"].encode())]


def entropies(models: list[Automaton], data: np.ndarray, offsets: np.ndarray, size: int = SEGMENT) -> np.ndarray:
    """Normalised phrases of each text (rows) in each language (columns); an empty text has none."""
    columns, lengths, owner = segments(data, offsets, size)
    texts = len(offsets) - 1
    out = np.zeros((texts, len(models)))
    for k, m in enumerate(models):
        found = np.bincount(owner, weights=m.phrases(columns, lengths), minlength=texts)
        out[:, k] = found * np.log2(m.sample + 2.0) / np.maximum(np.diff(offsets), 1)
    return out


def identify(docs: DataFrame, learnable: Column, segment: int = SEGMENT, **bounds: int) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``, learnt from its rows where ``learnable`` holds.

    A text that is null or has no letter is ``und`` with score 0, as are all texts where nothing is learnt. Ties go to the
    first language by name. The score is the lead over the next language: 1 - its normalised phrases over that one's, 1
    with only one language. Texts of any length are parsed whole; repeated rows each; rows with a null lang or text are
    not learnt from. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch.ship(spark)
    plain = F.when(F.col("text").rlike(r"\p{L}"), letters(F.col("text")))
    models = train(docs.where(learnable).select("lang", "text"), **bounds)
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([m.lang for m in known] + [UNKNOWN], dtype=object)
        for batch in batches:
            for start, stop, data, offsets in words.chunks(batch, "plain", CHUNK):
                has = np.diff(offsets) > 0
                best, score = np.full(stop - start, len(known)), np.zeros(stop - start)
                if known:
                    found = entropies(known, data, offsets, segment)
                    best = np.where(has, np.argmin(found, axis=1), len(known))
                    if len(known) > 1:
                        two = np.partition(found, 1, axis=1)
                        score = np.where(has, 1 - two[:, 0] / np.maximum(two[:, 1], 1e-300), 0.0)
                    else:
                        score = has.astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(names[best], type=pa.string()), pa.array(np.clip(score, 0.0, 1.0))], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", plain.alias("plain")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def is_held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: by the checksum of the id's digits. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame) -> DataFrame:
    """``identify`` with the fold of held-out documents told: doc_id, held_out, lang_pred, score."""
    return identify(docs, ~is_held_out(F.col("doc_id"))).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
