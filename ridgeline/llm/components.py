"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.sources.scratch import staged


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) of one task replaced by one edge from each node to its smallest reachable node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge to another one and is not the smallest of its component.

    ``edges`` has two bigint columns, in any order, with repeats and loops
    allowed; rows with a NULL end are ignored. Alternating large-star and
    small-star steps bring any component to a star in a number of rounds that
    grows with the logarithm of its size. Each step reads the smallest
    neighbour of a node from a written table, so a hub's edges meet it in a
    plain shuffle join, which adaptive execution splits; each round is written
    to the shared folder, so a lost executor costs a re-read.
    """
    u, v = edges.columns
    now = staged(
        edges.filter(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(),
        "edges",
    )
    before = _signature(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = staged(large.filter("u != v").distinct(), "star")
        least = staged(star.groupBy("u").agg(F.min("v").alias("m")), "small")
        moved = star.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = staged(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
