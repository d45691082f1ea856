"""Which keys of a batch are surely new: a filter of the stored keys, kept beside their table, settles most of them.

The filter is a table of bitmaps (page, bits) made by Spark's own bitmap aggregates. A key sets a few bits of one page by
different hashes, so that a look-up needs one row of the filter; a key of which any bit is not set has never been stored. Only the others, which may be stored, are looked up in
the table itself, which is then not shuffled. Filters of batches merge by or.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom import folders
from chainloom.operators import sinks

#: Bits set for each key, and bits that a filter has for each key so that about one in 50 new keys needs a look-up.
HASHES, BITS_EACH = 3, 10
#: Bits of a page, as the bitmap functions make them.
PAGE_BITS = 8 * 4096
#: Keys that may be stored up to which they are sent to all tasks.
BROADCAST_KEYS = 1_000_000


def bits_for(keys: int) -> int:
    """A size for so many keys, as a power of two."""
    return 1 << max(6, (keys * BITS_EACH - 1).bit_length())


def _page(keys: list[str], bits: int) -> Column:
    """The page of a key, counted from 1 as the bitmap functions do."""
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(max(1, bits // PAGE_BITS))) + 1


def _places(key: Column, bits: int) -> list[Column]:
    """The bits of a key in its page, by a hash of the key."""
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(min(bits, PAGE_BITS))) for seed in range(1, HASHES + 1)]


def build(stored: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """The filter (page, bits) of a table's keys. Two numbers for each key are shuffled, not a bitmap of each page by each task."""
    dealt = stored.select(_page(keys, bits).alias("page"), F.xxhash64(F.lit(1), *keys).alias("key")).repartition("page")
    places = dealt.select("page", F.explode(F.array(*_places(F.col("key"), bits))).alias("place"))
    return places.groupBy("page").agg(F.bitmap_construct_agg("place").alias("bits"))


def merge(one: DataFrame, other: DataFrame) -> DataFrame:
    """The filter of the keys of both, which have one size."""
    return one.unionByName(other).groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def marked(batch: DataFrame, existing: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Rows of a batch with one row for each key, and ``maybe``: whether the key may be stored."""
    return _looked_up(batch.withColumn("page__", _page(keys, bits)), existing, keys, bits)


def _looked_up(paged: DataFrame, existing: DataFrame, keys: list[str], bits: int) -> DataFrame:
    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits__", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.bit_get(byte, (at % 8).cast("int")) == 1, F.lit(False))

    rows = paged.join(existing.select(F.col("page").alias("page__"), F.col("bits").alias("bits__")), "page__", "left")
    maybe = F.lit(True)
    for at in _places(F.xxhash64(F.lit(1), *keys), bits):
        maybe &= is_set(at)
    return rows.withColumn("maybe", maybe).drop("page__", "bits__")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], existing: DataFrame, bits: int) -> DataFrame:
    """As ``sinks.insert_ignore``, with the filter of the target's keys: rows to append, one for each key that the table does
    not hold. The same for every size of the filter, even one that is full. Rows with a null in a key are always new.

    The batch is shuffled once, by page, for its first rows and for the filter; what is told of it is stored."""
    paged = batch.withColumn("page__", _page(keys, bits)).repartition("page__")
    order = [c for c in batch.columns if c not in keys]
    first = sinks.first_of_key(paged, ["page__", *keys], order) if order else paged.distinct()
    path = folders.new(batch.sparkSession, "marked")
    told = _looked_up(first, existing, keys, bits)
    told.write.parquet(path)
    rows = batch.sparkSession.read.schema(told.schema).parquet(path)
    doubtful = rows.where("maybe").drop("maybe")
    held = target.select(*keys)
    if doubtful.count() <= BROADCAST_KEYS:
        held = held.join(F.broadcast(doubtful.select(*keys)), keys, "left_semi").distinct()
    return rows.where("not maybe").drop("maybe").unionByName(doubtful.join(held, keys, "left_anti").select(*batch.columns))
