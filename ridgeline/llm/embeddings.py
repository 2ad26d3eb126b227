"""Embedding near-duplicates: int8 tile products with error bounds, exact checks where they leave doubt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.components import components, local_roots
from ridgeline.sources.scratch import staged

#: Classes of one side of a tile, and rows of it that are multiplied at a time.
TILE = 4096
STRIP = 512
#: Products of codes are whole numbers; up to this many components a float32 sum of them is exact.
EXACT = (1 << 24) // (127 * 127)


class Side:
    """Vectors of one block with their codes and error bounds."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, vectors: np.ndarray):
        self.ids, self.sizes, self.raw = ids, sizes, vectors
        # Dividing by the largest component first keeps squares of very large and very small ones finite.
        self.raw = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.raw, self.raw))
        unit = self.raw / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.code = np.rint(unit / self.scale[:, None]).astype(np.int8)
        near = self.code * self.scale[:, None]
        self.error = np.sqrt(((unit - near) ** 2).sum(axis=1)) + 1e-12
        self.length = np.sqrt((near**2).sum(axis=1))


def close_pairs(a: Side, b: Side, threshold: float, same: bool):
    """Positions (i, j) of pairs with cosine at least ``threshold``; each pair once if both sides are the same.

    For units x, y with decoded x', y': |xy - x'y'| <= |x'| |y - y'| + |x - x'|,
    as y has length one. A pair whose coded product plus that bound stays under
    the threshold cannot reach it; every other pair is computed in double.
    """
    left, right = [], []
    wide = a.code.shape[1] > EXACT
    codes = b.code.astype(np.float64 if wide else np.float32)
    scale = b.scale.astype(codes.dtype)
    loosest = b.error.max()
    for at in range(0, len(a.ids), STRIP):
        rows = slice(at, at + STRIP)
        product = a.code[rows].astype(codes.dtype) @ codes.T
        product *= scale
        least = (threshold - a.error[rows] - a.length[rows] * loosest - 1e-5) / a.scale[rows]
        i, j = np.nonzero(product >= least[:, None].astype(codes.dtype))
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        coded = np.einsum("ij,ij->i", a.code[i].astype(np.float64), b.code[j].astype(np.float64)) * a.scale[i] * b.scale[j]
        open_ = coded + a.length[i] * b.error[j] + a.error[i] >= threshold - 1e-9
        i, j = i[open_], j[open_]
        cosine = np.einsum("ij,ij->i", a.raw[i], b.raw[j]) / (a.norm[i] * b.norm[j])
        left.append(i[cosine >= threshold])
        right.append(j[cosine >= threshold])
    return np.concatenate(left), np.concatenate(right)


def _tile(table: pa.Table, threshold: float) -> pa.Table:
    """Links inside one tile: per class the number of vectors it links to here and its local root."""
    block = table["block"].to_numpy()
    ids, sizes = table["rep"].to_numpy(), table["size"].to_numpy()
    vectors = np.array(table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), -1)
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    sides = [Side(*(x[block == n] for x in (ids, sizes, vectors))) for n in ([low] if low == high else [low, high])]
    a, b = sides[0], sides[-1]
    kinds = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    if not len(a.ids) or not len(b.ids):
        return kinds.empty_table()
    i, j = close_pairs(a, b, threshold, low == high)
    if not len(i):
        return kinds.empty_table()
    u, v = a.ids[i], b.ids[j]
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, at, np.concatenate([b.sizes[j], a.sizes[i]]))
    moved, root = local_roots(u, v)
    roots = nodes.copy()
    roots[np.searchsorted(nodes, moved)] = root
    return pa.table([nodes, links, roots], schema=kinds)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Equal vectors are one class from the start, told apart by 128 bits of
    hashes; a class of any size is one row. Classes are dealt into blocks of
    about TILE, and every pair of blocks is one task that returns at most one
    row per class. So a pair is compared once, nothing is sampled, and no list
    of pairs leaves a task.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, nor do vectors of different lengths. Rows with a NULL id
    take no part (0 links, NULL component, not kept). Rows that repeat an id
    count as vectors of their own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = v.isNotNull() & (F.size(v) > 0) & whole & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"), F.coalesce(valid, F.lit(False)).alias("valid"))
    # 0.0 is added so that the two zeros hash alike.
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("k1", F.xxhash64(F.lit(1), plain)).withColumn("k2", F.xxhash64(F.lit(2), plain))
    classes = rows.filter("valid").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.any_value("vector").alias("vector")
    )
    classes = staged(classes.withColumn("dim", F.size("vector")), "classes")
    most = classes.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    blocks = -(-most // TILE) or 1
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tiles = dealt.withColumn("other", other).select(
        "dim", "rep", "size", "vector", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    schema = "rep long, links long, root long"
    found = staged(tiles.groupBy("dim", "low", "high").applyInArrow(lambda t: _tile(t, threshold), schema), "links")
    roots = components(found.select("rep", "root"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = (
        classes.select("k1", "k2", "rep", "size")
        .join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "k1",
            "k2",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    named = staged(named, "named")
    ids = rows.select("vec_id", "valid", F.when(F.col("valid"), F.col("k1")).alias("k1"), "k2")
    found_ids = ids.join(named, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found_ids.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
