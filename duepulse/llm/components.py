"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables


class Forest:
    """Components of edges held in memory, each named by its smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, a: int) -> int:
        parent = self.parent
        top = a
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(a, a)) != top:
            parent[a] = top
            a = up
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent.setdefault(a, a)
        self.parent.setdefault(b, b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes = [a for a, p in self.parent.items() if a != p]
        return np.array(nodes, dtype=np.int64), np.array([self.root(a) for a in nodes], dtype=np.int64)


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one batch as stars: as many components, no more edges than nodes."""
    for batch in batches:
        forest = Forest()
        a, b = (c.to_numpy() for c in batch.columns[:2])
        for x, y in np.unique(np.column_stack((a, b)), axis=0).tolist():
            forest.join(x, y)
        nodes, roots = forest.edges()
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["a", "b"])


def contracting(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work, which gives edges, with each of its batches as stars.

    Within one step: a step of its own for it would keep a second Python worker for each task.
    """
    return lambda batches: _contracted(work(batches))


#: Nodes with more than one in so many of all ends of edges are hubs; so there are fewer of them.
MOST_HUBS = 1024


def components(edges: DataFrame, most_rounds: int = 60, most_hubs: int = MOST_HUBS, contracted: bool = False) -> DataFrame:
    """Rows (node, component) for every node of the edges (a, b); component is its smallest node.

    Nodes are non-null longs; loops and repeated edges do no harm; no edges give no rows. A node
    with very many neighbours is pre-aggregated before each shuffle, and its edges are not brought
    together for the join: its smallest neighbour comes to them, as one of at most ``most_hubs``.
    Edges are made stars by batches first, unless ``contracted`` says that they are, without loops
    (:func:`contracting`).
    """
    now = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    if not contracted:
        now = now.mapInArrow(_contracted, "a long, b long")
    scratch = tables.Scratch(edges.sparkSession)
    now = scratch.stored(now.distinct())
    digest = _digest(now)
    for _ in range(most_rounds):
        # Large stars have at most two ends an edge, and no more edges than there were.
        frequent = 2 * digest[0] / most_hubs
        large = scratch.stored(_large_star(now, frequent))  # read three times
        after = scratch.stored(_small_star(large, frequent))
        if (found := _digest(after)) == digest:
            nodes = after.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return scratch.settled(nodes.unionByName(roots))
        now, digest = after, found
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _with_least(edges: DataFrame, least: DataFrame, frequent: float) -> DataFrame:
    """Edges with ``m`` of their ``a``; ``least`` has it and the number of edges, ``n``, of each a."""
    hubs = F.broadcast(least.where(F.col("n") > frequent).select("a", "m"))
    others = least.where(F.col("n") <= frequent).select("a", "m")
    return edges.join(hubs, "a").unionByName(edges.join(hubs.select("a"), "a", "left_anti").join(others, "a"))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))


def _large_star(edges: DataFrame, frequent: float) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).withColumn("m", F.least("a", "m"))
    return _with_least(both, least, frequent).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, frequent: float) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to its smallest neighbour."""
    least = _least(edges)
    joined = _with_least(edges, least, frequent)
    moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    """Number of the edges and two sums of their hashes, by which two sets are found equal."""
    h = [F.xxhash64(F.lit(seed), "a", "b").cast("decimal(20,0)") for seed in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *(F.sum(x) for x in h)).first())
