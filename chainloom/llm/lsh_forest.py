"""Near-duplicates by an LSH forest over MinHash signatures.

Each distinct set of five-word shingles is one node with a signature. A tree is an order of the nodes by some of the
signature's values; several trees use different values. In each order a node's neighbours are those with the longest
common prefix: in a crowded region these agree to a greater depth than in a thin one, so the depth adapts itself. Nodes
of regions that are too crowded for their neighbours to be told by one order go through further rounds of trees that
mix the signature's values anew, in which only nodes not yet linked are neighbours. What is left of them then is joined on
the rarest members of the full sets, which loses no link. Neighbours whose sketches agree
well enough become candidates, and candidates are confirmed on the full sets. A candidate is compared only while its ends
are in different components, which keeps large groups cheap and loses no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.llm import scratch, words
from chainloom.llm.components import components

WIDTH = 5  # words of a shingle
TREES, DEPTH = 20, 6  # orders, and signature values that each sorts by
#: Rounds of trees: how often the signature's values are mixed, and following nodes of an order that a node is held
#: against. The first round links most of a group of copies, so that few of them meet again in the next.
ROUNDS = ((0, 1), (0, 4), (1, 4), (2, 4))
LEAST_PREFIX = 2  # signature values on which neighbours agree at least
HASHES = 128  # MinHash values of a signature; two bits of each make the sketch
#: Of the similarity, from sketches. A pair at 0.75 lies below the least with a probability of 10^-8 at most.
LEAST_ESTIMATE, SURE_ESTIMATE = 0.45, 0.90
NUMERATOR, DENOMINATOR = 75, 100  # similarity of a link
RANGE_ROWS = 20_000  # rows of an order's range at least, on average
#: Members and sets of a block at most, on average, and members that are compared at once.
BLOCK_MEMBERS, BLOCK_NODES, CHUNK_MEMBERS = 1 << 16, 512, 1 << 12
PAIRS = 1_000  # pairs of sets that a task confirms at least, on average
#: Removed rows up to which a stage may broadcast their ids (16 bytes each).
BROADCAST_ROWS = 1_000_000

_SALTS = (words.mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, the offset of each text's first, and two 64-bit hashes of each text's set."""
    hashed, first = words.word_hashes(data, offsets)
    values, owner = words.shingles(hashed, first, WIDTH)
    values, at = words.distinct_per_text(values, owner, len(offsets) - 1)
    n = np.diff(at)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values), dtype=np.uint64)])
    again = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values ^ words.STEPS[0]), dtype=np.uint64)])
    node = words.mix((sums[at[1:]] - sums[at[:-1]]) ^ words.mix((again[at[1:]] - again[at[:-1]]) + n.astype(np.uint64)))
    third = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values ^ words.STEPS[1]), dtype=np.uint64)])
    check = words.mix((third[at[1:]] - third[at[:-1]]) + n.astype(np.uint64) * words.STEPS[2])
    return values, at, node.view(np.int64), check.view(np.int64)


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (16 bits) of each set that is not empty; zeros for empty ones."""
    n = np.diff(at)
    out = np.zeros((len(n), HASHES), dtype=np.uint16)
    full = np.flatnonzero(n)
    if len(full):
        low, begins = values.astype(np.uint32), at[:-1][full]
        for k in range(HASHES):
            least = np.minimum.reduceat((low ^ _SALTS[k]) * (_SALTS[HASHES + k] | np.uint32(1)), begins)
            out[full, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def sketches(signature: np.ndarray) -> np.ndarray:
    """Two bits of each value, packed into HASHES / 32 words of 64 bits."""
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    pairs = (signature & np.uint16(3)).astype(np.uint64).reshape(len(signature), -1, 32) << shifts
    return np.bitwise_or.reduce(pairs, axis=2)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from sketches: two bits agree by chance in one of four."""
    apart = a ^ b
    apart = (apart | (apart >> np.uint64(1))) & np.uint64(0x5555555555555555)
    same = 1.0 - np.bitwise_count(apart).sum(axis=1) / HASHES
    return (same - 0.25) / 0.75


def text_mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, node and check (hashes of the set; null for empty sets), signature and
    sketch."""
    scratch.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in words.chunks(batch, "text"):
                values, at, node, check = shingle_sets(data, offsets)
                n = np.diff(at)
                sign = signatures(values, at)
                packed = sketches(sign)
                keys = sign[:, : TREES * DEPTH].astype(">u2")  # big-endian, so that bytes sort as the values
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), batch.column(2).slice(start, stop - start), pa.array(n), pa.array(node, mask=n == 0), pa.array(check, mask=n == 0), pa.array([k.tobytes() for k in keys], type=pa.binary()), pa.array([p.tobytes() for p in packed], type=pa.binary())], names=["doc_id", "mark", "n_shingles", "node", "check", "signature", "sketch"])

    return docs.select("doc_id", "text", text_mark().alias("mark")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, mark bigint, n_shingles bigint, node bigint, check bigint, signature binary, sketch binary")


_ROWS = "tree tinyint, key binary, node bigint, root bigint, sketch binary"


def _near(rows: pa.RecordBatch, following: int, old: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (a < b, estimate) among sorted rows of ``_ROWS`` and so many that follow each, but for those within the
    first ``old`` rows and those with one root, which are linked already."""
    tree = rows.column(0).to_numpy()
    key = np.frombuffer(b"".join(rows.column(1).to_pylist()), dtype=">u2").reshape(-1, DEPTH)
    node, root = rows.column(2).to_numpy(), rows.column(3).to_numpy()
    sketch = np.frombuffer(b"".join(rows.column(4).to_pylist()), dtype=np.uint64).reshape(len(node), -1)
    found: list[tuple[np.ndarray, ...]] = [(node[:0], node[:0], np.zeros(0))]
    for step in range(1, following + 1):
        i = np.arange(max(0, old - step), max(0, len(node) - step))
        i = i[(tree[i] == tree[i + step]) & (root[i] != root[i + step]) & (key[i, :LEAST_PREFIX] == key[i + step, :LEAST_PREFIX]).all(axis=1)]
        guess = estimate(sketch[i], sketch[i + step])
        i, guess = i[guess >= LEAST_ESTIMATE], guess[guess >= LEAST_ESTIMATE]
        found.append((node[i], node[i + step], guess))
    a, b, guess = map(np.concatenate, zip(*found, strict=True))
    keep = a != b
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep], guess[keep]


def _crowded(rows: pa.Table, following: int) -> pa.Array:
    """Nodes of rows whose common prefix goes on beyond the rows that they are held against."""
    tree = rows["tree"].to_numpy()
    key = np.frombuffer(b"".join(rows["key"].to_pylist()), dtype=">u2").reshape(-1, DEPTH)
    i = np.arange(max(0, len(tree) - following - 1))
    j = i + following + 1
    i = i[(tree[i] == tree[j]) & (key[i, :LEAST_PREFIX] == key[j, :LEAST_PREFIX]).all(axis=1)]
    return pa.array(np.unique(rows["node"].to_numpy()[np.concatenate([i, i + following + 1])]), pa.int64())


def _in_task(batches: Iterator[pa.RecordBatch], following: int) -> Iterator[pa.RecordBatch]:
    """Candidates among a task's sorted rows; nodes of crowded regions, as candidates without a partner; its first and
    last rows, marked with the number of the border they lie at."""
    part = TaskContext.get().partitionId()
    held: pa.Table | None = None

    def border(rows: pa.Table, number: int) -> pa.RecordBatch:
        n = rows.num_rows
        names = ["a", "b", "guess", "border", *rows.schema.names]
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.array(np.full(n, number, dtype=np.int32)), *(c.combine_chunks() for c in rows.columns)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is None:
            yield border(table.slice(0, following + 1), part - 1)
        joined = table if held is None else pa.concat_tables([held, table])
        low, high, guess = _near(joined.combine_chunks().to_batches()[0], following, 0 if held is None else held.num_rows)
        crowded = _crowded(joined, following)
        held = joined.slice(max(0, joined.num_rows - following - 1))
        n = len(low)
        yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(guess), pa.nulls(n, pa.int32()), *(pa.nulls(n, f.type) for f in table.schema)], names=["a", "b", "guess", "border", *table.schema.names])
        n = len(crowded)
        yield pa.RecordBatch.from_arrays([crowded, pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.int32()), *(pa.nulls(n, f.type) for f in table.schema)], names=["a", "b", "guess", "border", *table.schema.names])
    if held is not None:
        yield border(held, part)


def _at_border(table: pa.Table, following: int) -> pa.Table:
    rows = table.sort_by([("tree", "ascending"), ("key", "ascending"), ("node", "ascending")]).combine_chunks()
    low, high, guess = _near(rows.select(["tree", "key", "node", "root", "sketch"]).to_batches()[0], following)
    crowded = _crowded(rows, following)
    n = len(crowded)
    return pa.table({"a": pa.concat_arrays([pa.array(low), crowded]), "b": pa.concat_arrays([pa.array(high), pa.nulls(n, pa.int64())]), "guess": pa.concat_arrays([pa.array(guess), pa.nulls(n, pa.float64())])})


def one_round(nodes: DataFrame, following: int) -> tuple[DataFrame, DataFrame]:
    """Candidate links (a < b, estimate) among neighbours with different roots in every tree, and the nodes of crowded
    regions, in which more rows share a prefix than were held against each other.

    The orders are cut into ranges; rows next to a cut meet once more for themselves, so that cuts part no neighbours.
    """
    trees = nodes.select("node", "root", "sketch", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    trees = trees.select(F.col("tree").cast("tinyint").alias("tree"), F.expr(f"substring(signature, tree * {2 * DEPTH} + 1, {2 * DEPTH})").alias("key"), "node", "root", "sketch")
    most = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * scratch.input_partitions(nodes))
    parts = max(1, min(most, nodes.count() * TREES // RANGE_ROWS))
    ordered = trees.repartitionByRange(parts, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    found = scratch.keep(ordered.mapInArrow(lambda batches: _in_task(batches, following), f"a bigint, b bigint, guess double, border int, {_ROWS}"), "neighbours")
    across = found.where("border is not null").select("border", "tree", "key", "node", "root", "sketch").groupBy("border").applyInArrow(lambda table: _at_border(table, following), "a bigint, b bigint, guess double")
    every = found.where("border is null").select("a", "b", "guess").unionByName(across)
    pairs = every.where("b is not null")
    return pairs.groupBy("a", "b").agg(F.max("guess").alias("guess")), every.where("b is null").select(F.col("a").alias("node")).distinct()


def mixed(signature: Column, number: int) -> Column:
    """A signature with its values dealt to the trees anew: the j-th value of tree t is that at t + TREES * j, and for
    further rounds that of a tree some steps on."""
    places = [(t + number * (number + 1) // 2 * j) % TREES * DEPTH + (j + number * t) % DEPTH for t in range(TREES) for j in range(DEPTH)]
    return F.concat(*(F.substring(signature, 2 * p + 1, 2) for p in places))


def neighbours(nodes: DataFrame) -> DataFrame:
    """Candidate links (a < b, estimate) of a round of trees in which nothing is linked yet."""
    return one_round(nodes.withColumn("root", F.col("node")), ROUNDS[-1][1])[0]


_LEAST_BITS, _MOST_BITS = 16, 25


def clashes(sets: DataFrame) -> DataFrame | None:
    """Of sets (node, check) with one first hash all but the first, with a hash of both as their ``fresh`` node; None if
    there are none, as in all but the largest corpora."""
    twice = sets.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("check").alias("first")).where("n > 1")
    twice = scratch.keep(twice.drop("n"), "clashes")
    if not twice.limit(1).count():
        return None
    return scratch.keep(sets.select("node", "check").join(F.broadcast(twice), "node").where("check <> first").select("node", "check", F.xxhash64("node", "check").alias("fresh")), "renamed")


def rename(rows: DataFrame, renamed: DataFrame | None) -> DataFrame:
    """Rows with the nodes of ``clashes`` (some pairs among 10^10 sets: small enough to be broadcast)."""
    if renamed is None:
        return rows
    return rows.join(F.broadcast(renamed), ["node", "check"], "left").withColumn("node", F.coalesce("fresh", "node")).drop("fresh")


def needed_sets(docs: DataFrame, nodes: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """node and its full set (sorted 64-bit shingles) for each row of ``nodes``, computed again from the texts.

    ``renamed`` has the sets whose node is not their first hash. A bitmap of at most 2^25 bits tells the tasks which sets may be needed; the exact choice is a join.
    """
    size = min(max(nodes.count().bit_length() + 3, _LEAST_BITS), _MOST_BITS)
    place = F.shiftrightunsigned("node", 64 - size)
    bits = nodes.groupBy(F.shiftright(place, 6).cast("int").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(node, {64 - size}) & 63 as int))")).alias("b"))
    bitmap = np.zeros(1 << (size - 6), dtype=np.int64)
    for row in bits.coalesce(8).toLocalIterator():  # one for each word of the bitmap at most
        bitmap[row["w"]] = row["b"]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = shared.value, set()
        for batch in batches:
            for _, _, data, offsets in words.chunks(batch, "text"):
                values, at, node, check = shingle_sets(data, offsets)
                p = node.view(np.uint64) >> np.uint64(64 - size)
                want = np.flatnonzero(((flags[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool) & (np.diff(at) > 0))
                chosen = [int(k) for k in want if (own := (int(node[k]), int(check[k]))) not in seen and not seen.add(own)]
                if chosen:
                    yield pa.RecordBatch.from_arrays([pa.array(node[chosen]), pa.array(check[chosen]), pa.array([values[at[k] : at[k + 1]].tobytes() for k in chosen], type=pa.binary())], names=["node", "check", "members"])

    sets = rename(docs.select("text").mapInArrow(run, "node bigint, check bigint, members binary"), renamed).drop("check")
    return scratch.keep(sets.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sets", "none")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left, right = (sets.select(F.col("node").alias(n), F.col("members").alias(f"set_{n}")) for n in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def link(docs: DataFrame, nodes: DataFrame, renamed: DataFrame | None = None) -> DataFrame | None:
    """node and root of every node that is linked with another; None where there are no candidates."""
    roots = sets = None
    rooted = nodes.withColumn("root", F.col("node"))
    for number, (mix, following) in enumerate(ROUNDS):
        if number:
            again = nodes.join(crowded, "node", "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))  # noqa: F821
            rooted = scratch.keep(again.withColumn("signature", mixed(F.col("signature"), mix)), "crowded-nodes", "none")
        left, crowded = one_round(rooted, following)
        left, crowded = scratch.keep(left, "candidates"), scratch.keep(crowded, "crowded")
        if sets is None:  # each crowded node has a candidate, if no better one than its neighbour in some order
            ends = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).unionByName(crowded)
            if renamed is not None:  # the bitmap is over first hashes
                ends = ends.unionByName(renamed.select("node"))
            ends = scratch.keep(ends.distinct(), "candidate-nodes")
            if not ends.limit(1).count():
                return None
            sets = needed_sets(docs, ends, renamed)
        roots = _confirmed(left, sets, roots)
        if not crowded.limit(1).count():
            break
        if not mix:  # further rounds mix the values anew: what shares a prefix of these orders, and was not held against it
            rest = crowded
    else:
        links = scratch.keep(sharing(rest, sets, roots), "links")
        if links.limit(1).count():
            roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return roots


def _crossed(table: pa.Table) -> pa.Table:
    """Links (a, b) between the sets of two blocks, or within one, that join different roots: those that no others imply.

    How many members two sets have in common is a product of matrices over the members of both blocks."""
    table = table.combine_chunks()
    side, node, root = (table[c].to_numpy() for c in ("side", "node", "root"))
    sets = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in table["members"]]
    n = np.array([len(m) for m in sets], dtype=np.int64)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(n)), n)
    often = times > 1  # a member of one set alone is in no other
    row, column = row[often[column]], (np.cumsum(often) - 1)[column[often[column]]]
    both = np.zeros((len(left), len(right)), dtype=np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(often.sum()), CHUNK_MEMBERS):
        some = slice(*np.searchsorted(column, [low, low + CHUNK_MEMBERS]))
        has = np.zeros((len(n), CHUNK_MEMBERS), dtype=np.float32)
        has[row[some], column[some] - low] = 1
        both += np.rint(has[left] @ has[right].T).astype(np.int64)
    alike = (DENOMINATOR * both >= NUMERATOR * (n[left][:, None] + n[right][None, :] - both)) & (root[left][:, None] != root[right][None, :])
    above: dict[int, int] = {}

    def top(r: int) -> int:
        while (up := above.get(r, r)) != r:
            above[r] = r = above.get(up, up)
        return r

    found = []
    for i, j in np.argwhere(alike):
        x, y = top(int(root[left[i]])), top(int(root[right[j]]))
        if x != y:
            above[x] = y
            found.append((left[i], right[j]))
    at = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(node[at[:, 0]], pa.int64()), "b": pa.array(node[at[:, 1]], pa.int64())})


def sharing(rest: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) among the nodes ``rest`` that join all components whose sets are similar enough.

    Of two sets that are, each has one of its rarest members in common with the rarest of the other: as many as it may lack
    and one more. Members that one component holds tell nothing. Nodes lie in blocks with others that have the same one of
    these members, or within a small region of nodes that such members connect; two blocks with such a member in common are
    compared whole, in one task: rows grow with the pairs of blocks, not of nodes.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in batch.column(2)]
            n = np.array([len(m) for m in members], dtype=np.int64)
            for low in range(0, len(n), 256):
                own = n[low : low + 256]
                columns = [np.repeat(c.to_numpy()[low : low + 256], own) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, np.repeat(own, own), np.concatenate(members[low : low + 256]))], names=["node", "root", "n", "member"])

    rooted = sets.join(rest, "node", "left_semi").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "members")
    rows = scratch.keep(rooted.mapInArrow(opened, "node bigint, root bigint, n bigint, member bigint"), "members")
    counts = rows.groupBy("member").agg(F.count(F.lit(1)).alias("f"), (F.min("root") != F.max("root")).alias("shared"))
    lacks = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    rare = rows.join(counts, "member").withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("f", "member")))
    rare = scratch.keep(rare.where(F.col("shared") & (F.col("rank") <= lacks + 1)).select("node", "n", "member", "f"), "rare")
    least = rare.groupBy("member").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").drop("last")
    edges = scratch.keep(rare.join(least, "member").select(F.col("node").alias("a"), "b").where("a <> b").distinct(), "regions")
    if not edges.limit(1).count():
        return edges
    regions = components(edges).withColumnRenamed("root", "region")
    hubs = rare.groupBy("node", "n").agg(F.max(F.struct("f", "member")).alias("most")).select("node", "n", F.col("most.member").alias("hub"))
    hubs = scratch.keep(hubs.join(regions, "node"), "hubs")
    room = F.ceil(F.greatest(F.sum("n") / BLOCK_MEMBERS, F.count(F.lit(1)) / BLOCK_NODES))
    own, split = hubs.groupBy("region").agg(room.alias("own")), hubs.groupBy("region", "hub").agg(room.alias("split"))
    block = F.xxhash64("region", F.pmod(F.xxhash64("hub"), F.col("own")), F.pmod(F.xxhash64("node"), F.col("split")))
    blocks = scratch.keep(hubs.join(own, "region").join(split, ["region", "hub"]).select("node", "own", block.alias("block")), "blocks")
    spans = scratch.keep(rare.join(blocks.where("own > 1"), "node").select("member", "block").distinct(), "spans")
    pairs = spans.withColumnRenamed("block", "block_a").join(spans.withColumnRenamed("block", "block_b"), "member").where("block_a < block_b").select("block_a", "block_b").distinct()
    pairs = pairs.unionByName(blocks.select(F.col("block").alias("block_a"), F.col("block").alias("block_b")).distinct())
    sides = pairs.select("block_a", "block_b", F.explode(F.expr("if(block_a = block_b, array(0), array(0, 1))")).alias("side")).withColumn("block", F.when(F.col("side") == 0, F.col("block_a")).otherwise(F.col("block_b")))
    placed = scratch.keep(rooted.join(blocks.drop("own"), "node"), "placed", "none")
    return sides.join(placed, "block").select("block_a", "block_b", "side", "node", "root", "members").groupBy("block_a", "block_b").applyInArrow(_crossed, "a bigint, b bigint")


def _confirmed(left: DataFrame, sets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The roots that follow from the links before and those among the candidates ``left`` that exact checks confirm.

    Each end's smallest sure neighbour, or else its most similar one, is checked first; then what still lies between
    different components.
    """
    count = left.count()
    if not count and roots is not None:
        return roots

    def joined(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
        links = confirm(pairs, sets)
        if (tasks := count // PAIRS + 1) < int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            links = links.coalesce(tasks)
        links = scratch.keep(links, "links")
        return components(links if roots is None else links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    sides = left.select(F.col("a").alias("from"), F.col("b").alias("to"), "a", "b", "guess").unionByName(left.select(F.col("b").alias("from"), F.col("a").alias("to"), "a", "b", "guess"))
    sure = F.col("guess") >= SURE_ESTIMATE
    best = F.struct(sure.alias("sure"), F.when(sure, -F.xxhash64("to").cast("double")).otherwise(F.col("guess")).alias("rank"), "guess", "a", "b")
    picks = scratch.keep(sides.groupBy("from").agg(F.max(best).alias("p")).select("p.a", "p.b").distinct(), "picks", most=count)
    roots = joined(picks, roots)
    rest = left.join(picks, ["a", "b"], "left_anti")
    for n in "ab":
        rest = rest.join(roots.select(F.col("node").alias(n), F.col("root").alias(f"r{n}")), n, "left").withColumn(f"r{n}", F.coalesce(f"r{n}", n))
    rest = scratch.keep(rest.where("ra <> rb").select("a", "b"), "candidates", most=count)
    count = rest.count()
    return joined(rest, roots) if count else roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Null and empty texts have no shingles: they stay alone and are kept. Rows with equal sets (by 128 bits) share a
    component; a text of any length gives one set, held whole by one task;
    repeated rows of one doc_id are all kept if that doc_id is the smallest of its component. A null doc_id is never
    the smallest unless a component has no other, and then such rows are kept. An empty table gives an empty result.
    Only doc_id and text are read.
    """
    return _labelled(docs).drop("mark")


def _labelled(docs: DataFrame) -> DataFrame:
    described = scratch.keep(describe(docs), "signatures")
    nodes = described.where("node is not null").groupBy("node", "check").agg(F.min("doc_id").alias("least"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
    nodes = scratch.keep(nodes, "nodes", "none")
    renamed = clashes(nodes)
    described, nodes = rename(described, renamed), rename(nodes, renamed).drop("check")
    roots = link(docs, nodes, renamed)
    plain = nodes.select("node", "least")
    if roots is not None:
        rooted = plain.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        # as a table of its own, so that both sides of the join are exchanges, which Spark can split where a root is hot
        smallest = scratch.keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
        plain = scratch.keep(rooted.join(smallest, "root").select("node", "component_id"), "labels")
    else:
        plain = plain.withColumnRenamed("least", "component_id")
    rows = described.select("doc_id", "mark", "n_shingles", "node").join(plain, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "mark", "n_shingles", component.alias("component_id"), is_kept(F.col("doc_id"), component).alias("kept"))


def is_kept(doc_id: Column, component: Column) -> Column:
    return F.coalesce(doc_id == component, component.isNull())


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; equal rows of a doc_id and text once.

    Rows without a doc_id give way to any row of their component that has one. The rows to remove are broadcast if they
    are few, and joined by Spark's own choice if not.
    """
    found = scratch.keep(_labelled(docs).select("doc_id", "mark", "kept"), "duplicates")
    removed = scratch.keep(found.where("not kept").select("doc_id", "mark").distinct(), "removed")
    twice = scratch.keep(found.where("kept").groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark"), "repeated")
    mark = next(n for k in range(len(docs.columns) + 1) if (n := f"mark{k}") not in docs.columns)
    rows = docs.withColumn(mark, text_mark())

    def among(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = some.select(F.col("doc_id").alias("d__"), F.col("mark").alias("m__"))
        small = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
        return rows.join(small, rows["doc_id"].eqNullSafe(small["d__"]) & (rows[mark] == small["m__"]), how)

    left = among(rows, removed, "left_anti")
    if twice.limit(1).count():
        left = among(left, twice, "left_anti").unionByName(among(left, twice, "left_semi").dropDuplicates(["doc_id", mark]))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))
