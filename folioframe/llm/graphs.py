"""Disjoint sets, and connected components of a distributed graph."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import dropped, lookup, written

#: So many edges of a graph, 16 bytes each, are finished in one task.
LOCAL_EDGES = 1_000_000


class Sets:
    """Disjoint sets over 0..n-1 with the smallest member as root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            self.flatten()
            x, y = self.up[a], self.up[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            open_ = lo != hi
            a, b = a[open_], b[open_]
            np.minimum.at(self.up, hi[open_], lo[open_])

    def flatten(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def _one_task(batches):
    """All edges, at most ``LOCAL_EDGES``, to (node, smallest node that it reaches)."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        u, v = (np.concatenate(x) for x in zip(*held, strict=True))
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        sets = Sets(len(nodes))
        sets.join(place[: len(u)], place[len(u) :])
        root = sets.flatten()
        for at in range(0, len(nodes), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 65_536]), pa.array(nodes[root[at : at + 65_536]])], ["id", "component"])


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (u, v): a row (id, component) for each node, component the smallest id.

    Alternating large-star and small-star steps: each replaces a node's edges by edges to
    its smallest neighbour, so the graph becomes a forest of stars after a number of rounds
    that grows with the logarithm of the diameter. A step is a minimum for each node (combined before
    the shuffle) and a skew-safe lookup; no task gets the neighbours of a node together.
    As soon as no more than ``LOCAL_EDGES`` edges (16 MB) are left, one task finishes them, with the same result.
    """
    spark = edges.sparkSession
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    digest = _digest(now)
    while digest[0] > LOCAL_EDGES:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = lookup(both, least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = lookup(large, small_least, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = written(moved.select("e.*").filter("u <> v").distinct())
        dropped(spark, now, large)
        now, before, digest = after, digest, _digest(after)
        if digest == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    return now.coalesce(1).mapInArrow(_one_task, "id long, component long")
