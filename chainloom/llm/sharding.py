"""Shards of near-equal bytes: a minimax contiguous partition of the groups of equal texts.

Groups are ordered by a 64-bit hash of the text. The driver holds a bounded summary of that order: segments with
their bytes and number of groups. It binary-searches the smallest capacity for which a greedy walk needs no more
than the given number of shards, once with segments that cannot be cut and once with segments that can be cut
anywhere. Where the two differ, only the segments in which a cut may fall are split further by a Spark job, until
both agree; the capacity and the cuts are then exact for the whole list of groups, however long it is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch

SHARDS = 16
FIRST_BITS, MORE_BITS = 12, 8


class Segments:
    """Segments in hash order: prefix sums of bytes, and which hold one group only."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        """rows: (prefix, bits, bytes, groups)."""
        rows = sorted(rows, key=lambda r: (r[0] << (64 - r[1])))
        self.rows = rows
        self.sizes = np.array([r[2] for r in rows], dtype=np.int64)
        self.single = np.array([r[3] == 1 for r in rows], dtype=bool)
        self.sums = np.concatenate([[0], np.cumsum(self.sizes)])
        self.total = int(self.sums[-1])

    def reach(self, start: int, capacity: int, divisible: bool) -> int:
        """The last byte position at which a shard that begins at ``start`` can end."""
        target = start + capacity
        k = int(np.searchsorted(self.sums, target, side="right")) - 1
        if k >= len(self.sizes):
            return self.total
        return target if divisible and not self.single[k] else max(start, int(self.sums[k]))

    def cuts(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        at, found = 0, []
        for _ in range(shards):
            at = self.reach(at, capacity, divisible)
            found.append(at)
        return found

    def smallest(self, shards: int, divisible: bool) -> int:
        atoms = self.sizes[self.single] if divisible else self.sizes
        low = max(int(atoms.max(initial=0)), -(-self.total // shards), 1)
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, divisible)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, shards: int) -> list[int]:
        """Segments of several groups in which a cut may fall."""
        low, high = self.smallest(shards, True), self.smallest(shards, False)
        if low == high:
            return []
        found: set[int] = set()
        for a, b in zip(self.cuts(low, shards, False), self.cuts(high, shards, True), strict=True):
            i, j = int(np.searchsorted(self.sums, a, side="right")) - 1, int(np.searchsorted(self.sums, b, side="left"))
            found.update(k for k in range(max(0, i), min(j, len(self.sizes))) if not self.single[k])
        return sorted(found)


def even_cuts(seg: Segments, shards: int) -> list[int]:
    """Cut positions within the smallest capacity, each as near an even share of what is left as it allows.

    Shares leave out groups larger than an even share, which fill a shard by themselves.
    """
    capacity = seg.smallest(shards, False)
    latest = seg.cuts(capacity, shards, False)
    earliest, at = [seg.total], seg.total
    for _ in range(shards - 1):
        k = int(np.searchsorted(seg.sums, at - capacity, side="left"))
        at = int(seg.sums[min(k, len(seg.sums) - 1)]) if at > capacity else 0
        earliest.append(at)
    earliest = earliest[::-1]
    found, at = [], 0
    for i in range(shards - 1):
        rest, left, share = seg.sizes[int(np.searchsorted(seg.sums, at)) :].astype(np.int64), shards - i, 0.0
        while left > 0:
            share = rest.sum() / left
            large = rest > max(share, 1)
            if not large.any() or large.sum() >= left:
                break
            left, rest = left - int(large.sum()), rest[~large]
        k = int(np.searchsorted(seg.sums, at + share))
        near = [int(seg.sums[j]) for j in (k - 1, k) if 0 <= j < len(seg.sums)] or [at]
        cut = min(near, key=lambda x: abs(x - at - share))
        low, high = max(at, earliest[i]), min(latest[i], seg.reach(at, capacity, False))
        at = min(max(cut, low), high)
        found.append(at)
    return [*found, seg.total]


def group_segments(groups: DataFrame, shards: int) -> Segments:
    """Refine a summary of ``groups`` (h, bytes) until every cut of the smallest capacity is exact."""

    def summary(df: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
        prefix = F.shiftright("h", 64 - bits).alias("prefix")
        found = df.groupBy(prefix).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups")).collect()
        return [(r["prefix"], bits, r["bytes"], r["groups"]) for r in found]

    seg = Segments(summary(groups, FIRST_BITS))
    while split := seg.unsure(shards):
        bits = min(seg.rows[k][1] for k in split)
        split = [k for k in split if seg.rows[k][1] == bits]
        finer = min(64, bits + MORE_BITS)
        inside = F.shiftright("h", 64 - bits).isin([seg.rows[k][0] for k in split])
        gone = set(split)
        seg = Segments([r for k, r in enumerate(seg.rows) if k not in gone] + summary(groups.where(inside), finer))
    return seg


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Law ``bytes``: equal texts share a shard, and the largest shard is as small as any contiguous partition of the
    groups in hash order allows. A null text has no bytes: size 1, CRC 0, and the group of the empty text. Repeated
    rows take a slot each, in the order of (text hash, doc_id); rows with a null doc_id come first there. An empty
    table gives an empty result. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
    parts = max(scratch.input_partitions(docs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = F.xxhash64("doc_id")
    ordered = rows.repartitionByRange(parts, "h", spread, "doc_id").sortWithinPartitions("h", spread, "doc_id")
    ordered = scratch.keep(ordered.withColumn("at", F.monotonically_increasing_id()), "sharding")
    seg = group_segments(ordered.groupBy("h").agg(F.sum("size").alias("bytes")), shards)
    if not seg.rows:
        return ordered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    cuts = even_cuts(seg, shards)
    # a cut at byte position p lies before the segment that starts there; hashes below its prefix are on its left
    starts = {int(seg.sums[k]): r[0] << (64 - r[1]) for k, r in reversed(list(enumerate(seg.rows)))}
    keys = [starts.get(p) for p in cuts[:-1]]
    shard = F.lit(0)
    for key in keys:
        if key is not None:
            shard = shard + F.when(F.col("h") >= F.lit(key).cast("long"), 1).otherwise(0)
    placed = ordered.withColumn("shard", shard.cast("int")).withColumn("part", F.shiftright("at", 33).cast("int"))
    counts = placed.groupBy("part", "shard").count().orderBy("part", "shard").collect()  # one row per partition and cut
    before_part: dict[int, int] = {}
    before_shard: dict[int, int] = {}
    seen = 0
    for part, s, n in sorted((r["part"], r["shard"], r["count"]) for r in counts):
        before_part.setdefault(part, seen)
        before_shard.setdefault(s, seen)
        seen += n
    base = spark.createDataFrame(sorted(before_part.items()), "part int, before long")
    first = F.element_at(F.create_map(*[F.lit(x).cast(t) for s, n in before_shard.items() for x, t in ((s, "int"), (n, "long"))]), F.col("shard"))
    index = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(base), "part").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (index - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
