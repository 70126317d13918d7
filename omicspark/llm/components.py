"""Connected components of an edge table by alternating star contractions; a graph of a stated size may end in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _toward_least(edges: DataFrame) -> DataFrame:
    """Large star: each node's greater neighbours are tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _among_smaller(edges: DataFrame) -> DataFrame:
    """Small star: each node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a whole graph that fits a task."""
    ends = [np.concatenate(x) for x in zip(*([c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches), strict=True)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    root, (a, b) = np.arange(len(nodes)), np.split(at, 2)
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        of_a, of_b = root[a], root[b]
        low = np.minimum(of_a, of_b)
        np.minimum.at(root, of_a, low)
        np.minimum.at(root, of_b, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])


def components(edges: DataFrame, u: str = "u", v: str = "v", small: int = 0) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node of its component.

    Loops and rows with nulls are dropped. Each round does two partial-aggregated shuffles over the edges and is cut by a
    checkpoint; nothing but two numbers a round reaches the driver. Up to `small` distinct edges (of bigint nodes) end in one
    task without rounds, whose many small files took more disk than their rows. An empty table gives an empty one.
    """
    a, b = F.col(u), F.col(v)
    now = cut(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        if state[0] <= small:
            return cut(now.coalesce(1).mapInArrow(_roots, "node bigint, root bigint"))
        seen = state
        now = cut(_among_smaller(_toward_least(now)))
