"""Phrase collocations: runs of words that occur together more often than their parts would make one expect.

All runs of 1 to ``most_words`` words become rows (lang, phrase, count) and are summed by language and phrase. Each phrase
that is frequent enough is cut in two in every way; the counts of both parts are joined, the cut with the lowest score
decides, and phrases that mostly occur inside a longer one go. Tasks count within a chunk of text first, and leave out
runs that cannot reach the least count because a shorter run inside them does not: a bitmap of the frequent shorter runs
tells which, and it never misses one of those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm import scratch, words

U64 = np.uint64
#: Bytes of text whose runs are counted together; a longer text is cut between words.
CHUNK = 1 << 20
#: Bits of the bitmap for each frequent run, and the most bits that it is given: what goes to all tasks is at most 64 MB.
BITS_EACH, MOST_BITS = 16, 1 << 29
#: Documents that pass between Spark and a task's Python at once: with more, their buffers take most of its memory.
BATCH_ROWS = 1000
#: Rows that one task ranks.
RANKED_ROWS = 100_000

_BLANK, _BREAK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"
_APART = re.compile(rb"[ \t.,;:!?\n-\r]")


def _more_words(n: int) -> re.Pattern[bytes]:
    """Up to n words of the piece that goes on."""
    return re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % n)


def spans(text: bytes, most_words: int, chunk: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts: the bytes of each and the end of those whose runs start in it. What follows are the words that
    such runs reach into."""
    at, reach = 0, _more_words(most_words - 1)
    while at < len(text):
        found = _APART.search(text, at + chunk)
        end = found.start() if found else len(text)
        yield text[at : reach.match(text, end).end()], end - at
        at = end


def _chunks(texts: pa.Array, langs: pa.Array, most_words: int, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Bytes, offsets, the end of each text's own bytes and the languages of some texts at a time."""
    data, offsets = words.text_bytes(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + chunk, side="right")) - 1
        if stop > start:
            own = offsets[start + 1 : stop + 1] - offsets[start]
            yield data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], own, langs.slice(start, stop - start)
        else:
            stop = start + 1
            for part, own_end in spans(data[offsets[start] : offsets[stop]].tobytes(), most_words, chunk):
                yield np.frombuffer(part, dtype=np.uint8), np.array([0, len(part)]), np.array([own_end]), langs.slice(start, 1)
        start = stop


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, its text, and the piece that it lies in."""
    apart = _BREAK[data]
    inside = ~(_BLANK[data] | apart)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.flatnonzero(finish) + 1, owner, np.cumsum(apart)[starts] + owner if len(data) else starts


def _hashes(text: pa.Array) -> np.ndarray:
    """A hash of each string's bytes."""
    data, offsets = words.text_bytes(text)
    return words.hash_words(data, offsets[:-1], offsets[1:], lower=False)


def _join_hash(lang: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """A hash of a language and a run of words, from theirs."""
    out = words.mix(lang + U64(0x632BE59BD9B4E019))
    for k, part in enumerate(parts):
        out = words.mix(out * U64(0x9E3779B97F4A7C15) + part + U64(k))
    return out


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & U64(len(bits) * 8 - 1)
    return (bits[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 > 0


def runs(batch: pa.RecordBatch, size: int, most_words: int, bits: np.ndarray | None, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Runs of ``size`` words in rows (lang, phrase, count) of a batch (lang, text); with ``bits``, those only whose two
    runs of one word less may be frequent. For size 1, a row with a null phrase also counts a chunk's words."""
    for data, offsets, own, langs in _chunks(batch.column(1), batch.column(0), most_words, chunk):
        data = words._LOWER[data]
        starts, ends, owner, piece = _cut(data, offsets)
        if not len(starts):
            continue
        inner = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(~(_BLANK[data] | _BREAK[data]), out=inner[1:])
        joined = data[np.flatnonzero(np.diff(inner))]
        edges = np.append(inner[starts], inner[-1])
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(joined))])
        coded = every.dictionary_encode()
        lang = langs.dictionary_encode()
        known, names = coded.dictionary.cast(pa.large_string()), lang.dictionary
        word, tongue = coded.indices.to_numpy().astype(np.int64), lang.indices.to_numpy().astype(np.int64)[owner]
        at = np.flatnonzero(starts < own[owner])
        at = at[at + size <= len(starts)]
        at = at[piece[at] == piece[at + size - 1]]
        if bits is not None:
            plain, of_lang = _hashes(known), _hashes(names)
            for shift in (0, 1):
                at = at[_has(bits, _join_hash(of_lang[tongue[at]], [plain[word[at + shift + k]] for k in range(size - 1)]))]
        # numbers of the distinct runs, made word by word so that they stay small
        code = tongue[at]
        for k in range(size):
            values, code = np.unique(code * len(known) + word[at + k], return_inverse=True)
        where = np.zeros(len(values) if size else 0, dtype=np.int64)
        where[code] = at
        counts = np.bincount(code, minlength=len(where))
        parts = [known.take(pa.array(word[where + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
        yield _rows(names.take(pa.array(tongue[where])), phrase.cast(pa.string()), counts)
        if size == 1:
            total = np.bincount(tongue[at], minlength=len(names))
            yield _rows(names, pa.nulls(len(names), pa.string()), total)


def _rows(lang: pa.Array, phrase: pa.Array, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase, pa.array(count, type=pa.int64())], names=["lang", "phrase", "a"])


def _bitmap(frequent: DataFrame, rows: int) -> np.ndarray:
    """Bits of all frequent runs; many of them share bits, which lets more rows through and loses none."""
    size = 1 << min(MOST_BITS.bit_length() - 1, max(16, (rows * BITS_EACH).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.split_pattern(batch.column(1), " ")
            flat, counts = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy()
            hashed = _hashes(flat).reshape(-1, counts[0]) if len(counts) else np.zeros((0, 1), U64)
            found = _join_hash(_hashes(batch.column(0)), list(hashed.T)) & U64(size - 1)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64) + 1)], names=["place"])

    # bits are gathered in pages of 4096 bytes by Spark's own aggregate, which counts places and pages from 1
    page, bit = F.bitmap_bucket_number("place"), F.bitmap_bit_position("place")
    pages = frequent.select("lang", "phrase").mapInArrow(places, "place long").groupBy(page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    out = np.zeros(size >> 3, dtype=np.uint8)
    for r in pages.toLocalIterator():  # at most MOST_BITS / 32768 pages
        out[(r["page"] - 1) * 4096 : r["page"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def frequent_runs(docs: DataFrame, least: int, most_words: int, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Two kept tables: (lang, phrase, words, a) of all runs that occur ``least`` times, and (lang, n)."""
    spark = docs.sparkSession
    scratch.ship(spark)
    batch_rows = spark.conf.get(_BATCHES)
    spark.conf.set(_BATCHES, min(BATCH_ROWS, int(batch_rows)))
    try:
        return _frequent_runs(docs, least, most_words, chunk)
    finally:
        spark.conf.set(_BATCHES, batch_rows)


def _frequent_runs(docs: DataFrame, least: int, most_words: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """``frequent_runs`` in the session's present settings; all of its jobs run here."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    found: list[DataFrame] = []
    totals, bits = None, None
    for size in range(1, most_words + 1):
        shared = spark.sparkContext.broadcast(bits)

        def explode(batches: Iterator[pa.RecordBatch], size: int = size, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from runs(batch, size, most_words, shared.value, chunk)

        summed = texts.mapInArrow(explode, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        kept = scratch.keep(summed.where(F.col("phrase").isNull() | (F.col("a") >= least)), f"runs-{size}")
        if size == 1:
            totals = kept.where("phrase is null").select("lang", F.col("a").alias("n"))
        kept = kept.where("phrase is not null")
        found.append(kept.select("lang", "phrase", F.lit(size).alias("words"), "a"))
        shared.unpersist()
        if size < most_words:
            bits = _bitmap(kept, kept.count())
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals: exact for counts below 10^14."""
    wide = [c.cast("decimal(14,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2]).cast("long")


def _words(first: Column | int, count: Column | int) -> Column:
    """Some words of a phrase, joined again."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def best(rows: DataFrame, keys: list[str], order: list[Column], limit: int, total: int) -> DataFrame:
    """The first ``limit`` rows of each group with their rank. Large groups are ranked in random shares first, whose own
    first rows go on, so that no task ranks a whole group."""
    shares = 1
    while shares * RANKED_ROWS < total:
        shares *= 32
    while shares > 1:
        share = F.pmod(F.xxhash64(*rows.columns), F.lit(shares))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, share).orderBy(*order))).where(F.col("rank") <= limit).drop("rank")
        shares //= 32
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= limit)


def collocations(docs: DataFrame, least: int = 10, most_words: int = 3, inside_percent: int = 50, limit: int = 2000, chunk: int = CHUNK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of 2 to ``most_words`` words of each language.

    A null text has no words; a null language counts as ``und``, together with that name; repeated rows count each.
    Texts of any length are read whole, in chunks. Ties in score and count go by the bytes of the phrase; of cuts with
    equal scores the first counts. An empty table, or one without frequent phrases, gives no rows. Other columns are not
    read. The least count is at least 1.
    """
    runs_, totals = frequent_runs(docs, max(1, least), most_words, chunk)
    whole = runs_.where("words > 1")
    cuts = whole.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    parts = cuts.select("lang", "phrase", "a", "k", _words(1, F.col("k")).alias("first__"), _words(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest__"))
    left = runs_.select("lang", F.col("phrase").alias("first__"), F.col("a").alias("l"))
    right = runs_.select("lang", F.col("phrase").alias("rest__"), F.col("a").alias("r"))
    scored = parts.join(left, ["lang", "first__"]).join(right, ["lang", "rest__"])
    scored = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))
    # a run inside a longer one lies in one with one word more, which is as frequent as the longer one at least
    inner = runs_.where("words > 2").select("lang", "a", F.explode(F.array(_words(1, F.col("words") - 1), _words(2, F.col("words") - 1))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.alias("s").join(inner.alias("i"), (F.col("s.lang") == F.col("i.lang")) & (F.col("s.phrase") == F.col("i.phrase")) & (100 * F.col("longer") >= inside_percent * F.col("a")), "left_anti")
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = best(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], limit, runs_.count())
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
