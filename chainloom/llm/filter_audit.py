"""What each filter of a chain removes, in every order of the filters.

Each document gets a mask of the filters that it fails; counts of masks tell what any order removes at any step. The
filter that needs other documents, equality with an earlier text, is found by refining a partition: documents are split
by the length of their texts, then by hashes of one block after another, each longer than the last; classes of one
document are dropped at once. Texts that are together to the end are compared as a whole with that of the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from chainloom.llm import scratch

FILTERS = "ABCDE"
#: First byte of each block and, but for the last, of the one after it.
BLOCKS = [0, 64, 512, 4096, 32768, 262144]
#: Classes of equal texts that may be sent to all tasks: less than 50 MB.
BROADCAST_CLASSES = 300_000
#: Texts that are compared with one copy of their class's first text.
SHARE_ROWS = 1000
#: Bytes of a text whose words are told apart at once.
PIECE = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"


def count_words(text: bytes, piece: int = PIECE) -> tuple[int, int]:
    """All and distinct words ``[^\\x20\\x09-\\x0D]+`` of a text, which is split in pieces so that only distinct ones are held."""
    if len(text) <= piece:
        found = text.split()
        return len(found), len(set(found))
    count, distinct, at = 0, set(), 0
    while at < len(text):
        end = min(at + piece, len(text))
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        found = text[at:end].split()
        count += len(found)
        distinct.update(found)
        at = end
    return count, len(distinct)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns, the last of which is the text, and the counts of its words."""
    for batch in batches:
        found = [count_words(t.as_py()) for t in batch.column(batch.num_columns - 1).cast(pa.binary())]
        numbers = [pa.array([f[k] for f in found], type=pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=[*batch.schema.names, "words", "distinct"])


def own_mask(few: int, distinct_percent: int, upper_percent: int) -> Column:
    """Bits of the filters A to D that a row (words, distinct, points, capitals, signs) fails."""
    fails = [F.col("words") < few, 100 * F.col("distinct") < distinct_percent * F.col("words"), 100 * F.col("capitals") > upper_percent * F.col("points"), F.col("signs")]
    total = F.lit(0)
    for k, f in enumerate(fails):
        total = total + F.when(f, 1 << k).otherwise(0)
    return total


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))


def _judged(rows: DataFrame, rule: Column) -> DataFrame:
    """``rows`` with the mask of filters that the text fails by itself."""
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    facts = rows.select(*(c for c in rows.columns if c != "text"), F.length("text").alias("points"), capitals.alias("capitals"), F.col("text").rlike(r"[#$%&*|]").alias("signs"), "text")
    schema = StructType([*facts.schema.fields, StructField("words", LongType()), StructField("distinct", LongType())])
    return facts.mapInArrow(_word_counts, schema).select(*rows.columns, rule.alias("mask"))


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def _keys(rows: DataFrame) -> DataFrame:
    """``rows`` with the length of the text and a hash of each block, null behind its end."""
    data = F.col("text").cast("binary")
    size = F.octet_length("text")
    ends = [*BLOCKS[1:], None]
    hashes = [F.when(size > at, block_hash(F.substring(data, at + 1, (end - at) if end else (1 << 31) - 1))).alias(f"h{k}") for k, (at, end) in enumerate(zip(BLOCKS, ends, strict=True))]
    return rows.withColumn("points", F.length("text")).select("*", *hashes)


KEY = ["points", *(f"h{k}" for k in range(len(BLOCKS)))]


def refine(keyed: DataFrame) -> DataFrame:
    """Classes of rows (doc_id, key) that agree in the whole key: the key, rows and first (the smallest doc_id).

    One split for each part of the key: rows whose class has shrunk to one leave before the next split.
    """
    rows = keyed
    for depth in range(1, len(KEY)):
        names = KEY[:depth]
        shared = rows.groupBy(*(F.col(n).alias(f"shared_{n}") for n in names)).agg(F.count(F.lit(1)).alias("rows__")).where("rows__ > 1").drop("rows__")
        same = [F.col(n).eqNullSafe(F.col(f"shared_{n}")) for n in names]
        rows = rows.join(shared, same, "left_semi")
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first")).where("rows > 1 and first is not null")


def repeated(rows: DataFrame, rule: Column) -> DataFrame:
    """doc_id, part and mask of the rows (doc_id, part, text) whose text equals that of a row with a smaller doc_id."""
    keyed = _keys(rows)
    classes = scratch.keep(refine(keyed.select("doc_id", *KEY)), "audit-classes")
    few = classes.count() <= BROADCAST_CLASSES
    classes = classes.select(F.struct(*KEY).alias("class"), "rows", "first")
    told = F.broadcast(classes) if few else classes
    members = keyed.select("doc_id", "part", F.struct(*KEY).alias("class"), "text").join(told, "class")
    # a large class is compared in shares, each with a copy of its first text
    shares = F.floor(F.col("rows") / SHARE_ROWS).cast("int") + 1
    firsts = members.where("doc_id = first").groupBy("class", "rows").agg(F.min("text").alias("whole"))
    firsts = firsts.select("class", "whole", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    later = members.where("doc_id > first").withColumn("share", F.pmod(F.xxhash64("doc_id", "part"), shares).cast("int"))
    later = _judged(later.select("doc_id", "part", "class", "share", "text"), rule)
    met = later.join(firsts, ["class", "share"])
    told_apart = scratch.keep(met.select("doc_id", "part", "mask", (F.col("text") == F.col("whole")).alias("same")), "audit-compared")
    found = told_apart.where("same").drop("same")
    if not told_apart.where("not same").isEmpty():  # texts that only their hashes make alike are compared among themselves
        odd = met.where("text <> whole")
        least = odd.groupBy("class", "text").agg(F.min("doc_id").alias("least"))
        found = found.unionByName(odd.join(least, ["class", "text"]).where("doc_id > least").select("doc_id", "part", "mask"))
    return found


def _steps() -> list[tuple[str, int, int, int]]:
    """filter_order, step, the bit of its filter and those of the filters before it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[k] for k in order), step, 1 << f, before))
            before |= 1 << f
    return out


def _total(condition: Column, what: str = "n", times: Column | None = None) -> Column:
    """Sum over a part's masks: of field ``what`` of those that meet a condition on the variable m."""
    return F.aggregate(F.col("masks"), F.lit(0).cast("long"), lambda s, m: s + F.when(condition(m), (times(m) if times else F.lit(1)) * m[what]).otherwise(F.lit(0)))


def audit(docs: DataFrame, labels: DataFrame, few: int = 50, distinct_percent: int = 65, upper_percent: int = 5) -> DataFrame:
    """part, filter_order, step, filter and the counts kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A document fails A with fewer than ``few`` words, B with fewer distinct words in a hundred than ``distinct_percent``,
    C with more capitals A-Z in a hundred code points than ``upper_percent``, D with one of ``#$%&*|`` and E with the text of
    a smaller doc_id. A null text counts as an empty one, so that it equals that; a null source as the empty string; a row
    with a null doc_id is never the earlier or the later of two. Repeated rows count each, and do not repeat one another
    under one doc_id. A document is good, or toxic, if any of its labels says so. Texts of any length are judged whole. An
    empty table gives no rows; other columns are not read.
    """
    scratch.ship(docs.sparkSession)
    rows, rule = _texts(docs), own_mask(few, distinct_percent, upper_percent)
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))

    def counts(judged: DataFrame) -> DataFrame:
        known = judged.join(marks, "doc_id", "left")
        return known.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))

    numbers = ["n", "good", "toxic"]
    every = counts(_judged(rows, rule).drop("text"))
    # documents that repeat another move from their own mask to the one with E
    again = scratch.keep(counts(repeated(rows, rule)), "audit-repeated")
    out_of = again.select("part", "mask", *((-F.col(c)).alias(c) for c in numbers))
    into = again.withColumn("mask", F.col("mask") + (1 << FILTERS.index("E")))
    masks = every.unionByName(out_of).unionByName(into).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in numbers))
    # at most 32 masks a part
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *numbers, F.bit_count("mask").alias("failed"))).alias("masks"))
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before")) for o, s, b, p in _steps()))
    each = parts.select("part", "masks", F.explode(steps).alias("at")).select("part", "masks", "at.*")
    bit, before = F.col("bit"), F.col("before")

    def has(m: Column, bits: Column) -> Column:
        return m["mask"].bitwiseAND(bits) != 0

    def removed(m: Column) -> Column:
        return has(m, bit) & ~has(m, before)

    orders = len(list(permutations(FILTERS)))
    return each.select(
        "part", "filter_order", "step", F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
        _total(lambda m: ~has(m, before) & ~has(m, bit)).alias("kept"),
        _total(removed).alias("removed"),
        _total(lambda m: has(m, bit) & has(m, before)).alias("redundant"),
        _total(lambda m: m["mask"] == bit).alias("unique_fails"),
        _total(removed, "good").alias("good_lost"),
        _total(removed, "toxic").alias("toxic_lost"),
        # of all orders, one in as many as the filters that a document fails has this filter as the first of them
        _total(lambda m: has(m, bit), "n", lambda m: F.floor(F.lit(orders) / m["failed"])).alias("shapley"),
    )
