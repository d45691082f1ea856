"""Connected components of a graph given as a table of edges, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch


class Forest:
    """Union-find over the nodes of one task; the smallest node is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


#: Edges that a task contracts at once, and up to which one task does all of them.
CONTRACT, ALONE = 200_000, 400_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task by a star around the smallest node of each of their components."""

    def stars(forest: Forest) -> pa.RecordBatch:
        nodes = list(forest.parent)
        return pa.RecordBatch.from_arrays([pa.array(nodes, type=pa.int64()), pa.array([forest.root(n) for n in nodes], type=pa.int64())], names=["u", "v"])

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) >= CONTRACT:
            yield stars(forest)
            forest = Forest()
    yield stars(forest)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node with its root, where one task has all edges."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list({*forest.parent, *forest.parent.values()})
    yield pa.RecordBatch.from_arrays([pa.array(nodes, type=pa.int64()), pa.array([forest.root(n) for n in nodes], type=pa.int64())], names=["node", "root"])


#: Nodes up to which the smallest neighbours of all nodes (16 bytes each) may be broadcast.
BROADCAST_NODES = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node in ``edges`` (a, b: long).

    A star's centre has as many rows as its component has nodes. Its smallest neighbour reaches them by a broadcast
    if there are few nodes in all, or else by a join of two tables, whose hot keys Spark can split.
    """

    def measure() -> tuple:
        return tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    def smallest(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("u").agg(F.min("v").alias("m"))
        return F.broadcast(least) if 2 * mark[0] <= BROADCAST_NODES else scratch.keep(least, "smallest")

    edges = edges.select("a", "b").where("a <> b")
    most = edges.count()  # no state has more rows
    if most <= ALONE:
        return scratch.keep(edges.coalesce(1).mapInArrow(_roots, "node long, root long"), "components")
    tasks = scratch.tasks_for(most)
    state = scratch.keep(edges.coalesce(tasks).mapInArrow(_contract, "u long, v long"), "stars")
    mark = measure()
    before = None
    while mark != before:
        # large star: neighbours larger than a node are joined to the smallest around it
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = scratch.keep(large, "stars", most=most)
        # small star: a node and its smaller neighbours are joined to the smallest of them
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        state = scratch.keep(small, "stars", most=most)
        mark, before = measure(), mark
    roots = state.select("v").distinct()
    return scratch.keep(state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))), "components", most=2 * most)
