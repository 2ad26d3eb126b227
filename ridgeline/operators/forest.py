"""Growing a regression forest over binned rows, all trees of a level in one job.

Every number of a vector becomes the number of its bin once. Of a row only the
entries of its sparse vector are added up; what a node holds beside them lies in
the bin of zero. A task sums its rows per tree, node and bin, the sums meet in a
shuffle, the best split of a node is found where its sums lie, and the driver
holds the forest itself, as Spark ML does. The rules are those of Spark ML:
bins of about equal weight, Poisson bootstrap, a third of the features per node,
variance, and no split without a gain. The result is a Spark ML model.

Sums that decide splits are whole numbers, so they do not depend on the order of
adding, and the same rows give the same splits on any cluster.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel, cloudpickle
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.sources.scratch import scratch_path

# Tasks get these functions by value, wherever this package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A task sums the nodes of every tree over its rows: more rows, fewer sums to shuffle.
ROWS_PER_TASK = 600_000
# Sums of one tree that a task holds at a time; nodes beyond them are summed after.
CELLS = 1 << 20
# Rows that are added up at a time, where the sums are few; their columns fit the core's memory.
STRIP = 32_768
# Values by which a block of rows describes a feature that has more: each stands for
# as many rows as any other, and together for all.
POINTS = 1024
# Whole sums stay below 2 ** 53 when the cells of a node are added up.
SUM_BITS = 50
# A gain below this part of the squared sums is rounding.
NOISE = 1e-12


@dataclass
class Bins:
    """Cells of all features one after the other; feature f has ``starts[f + 1] - starts[f]``, cut at its thresholds."""

    thresholds: np.ndarray
    starts: np.ndarray

    def __post_init__(self):
        features = len(self.starts) - 1
        self.cells = int(self.starts[-1])
        self.feature = np.repeat(np.arange(features), np.diff(self.starts))
        #: Where the thresholds of a feature start: it has one less than cells.
        self.cuts = self.starts - np.arange(features + 1)
        self.zero = self.starts[:-1] + self._bin(np.arange(features), np.zeros(features))
        self.last = np.zeros(self.cells, bool)
        self.last[self.starts[1:] - 1] = True
        self.code_type = np.uint16 if self.cells < 65_000 else np.uint32

    def _bin(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Number of the bin of every value in its feature: how many thresholds lie below it."""
        first, many = self.cuts[feature], self.cuts[feature + 1] - self.cuts[feature]
        out = np.zeros(len(feature), np.int64)
        one = many > 0
        out[one] = value[one] > self.thresholds[first[one]]
        more = np.flatnonzero(many > 1)
        more = more[np.argsort(feature[more], kind="stable")]
        found, first = np.unique(feature[more], return_index=True)
        for f, at in zip(found, np.split(more, first[1:])):
            out[at] = np.searchsorted(self.thresholds[self.cuts[f] : self.cuts[f + 1]], value[at], "left")
        return out

    def codes(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        return self.starts[feature] + self._bin(feature, value)


@dataclass
class Growth:
    """What a fit asks of every task."""

    bins: Bins
    trees: int
    per_node: int
    min_leaf: int
    seed: int
    unit: float
    bootstrap: bool

    def plain(self) -> tuple:
        """What a broadcast carries: arrays and numbers, which need no class of this package to be read."""
        return (self.bins.thresholds, self.bins.starts, self.trees, self.per_node, self.min_leaf, self.seed, self.unit, self.bootstrap)

    @staticmethod
    def of(shared: Broadcast) -> Growth:
        thresholds, starts, *rest = shared.value
        return Growth(Bins(thresholds, starts), *rest)

    @property
    def chunk(self) -> int:
        """Nodes that are summed at a time."""
        return max(1, CELLS // (self.bins.cells + 1))


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label, entries per row, feature and value of every entry) of rows with ``label`` and an unwrapped vector."""
    vectors = batch.column("vector")
    values, indices, kind = vectors.field("values"), vectors.field("indices"), vectors.field("type").to_numpy(zero_copy_only=False)
    many = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)  # a dense vector names no places
    sparse = np.repeat(kind == 0, many)
    place[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return batch.column("label").to_numpy(zero_copy_only=False), many, place, flat


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, value, n) of a block's entries that are not zero: every value, or POINTS of a feature that has more."""
    parts = [_entries(b)[2:] for b in batches if b.num_rows]
    if not parts:
        return
    feature, value = (np.concatenate(x) for x in zip(*parts))
    some = value != 0
    feature, value = feature[some], value[some]
    order = np.lexsort((value, feature))
    feature, value = feature[order], value[order]
    new = np.r_[True, (np.diff(feature) != 0) | (np.diff(value) != 0)][: len(value)]
    at = np.flatnonzero(new)
    feature, value, n = feature[at], value[at], np.diff(np.r_[at, len(order)])
    found, first, distinct = np.unique(feature, return_index=True, return_counts=True)
    group = np.zeros(len(feature), np.int64)
    for start, size in zip(first[distinct > POINTS], distinct[distinct > POINTS]):
        rank = np.cumsum(n[start : start + size])
        group[start : start + size] = (rank - 1) * POINTS // rank[-1]
    group[np.repeat(distinct <= POINTS, distinct)] = np.arange(len(feature))[np.repeat(distinct <= POINTS, distinct)]
    starts = np.flatnonzero(np.r_[True, (np.diff(feature) != 0) | (np.diff(group) != 0)][: len(group)])
    if len(starts):
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(feature[starts], pa.int32()), "value": pa.array(value[starts]), "n": pa.array(np.add.reduceat(n, starts), pa.int64())}
        )


def thresholds_between(values: np.ndarray, weights: np.ndarray, splits: int) -> list[float]:
    """Cuts between distinct sorted values: all of them, or ``splits`` at about equal weights, as Spark ML places them."""
    middle = values[:-1] / 2 + values[1:] / 2
    if len(middle) <= splits:
        return middle.tolist()
    stride, cuts = weights.sum() / (splits + 1), []
    counts, target = np.cumsum(weights), weights.sum() / (splits + 1)
    for i, (before, after) in enumerate(zip(counts[:-1].tolist(), counts[1:].tolist())):
        if abs(before - target) < abs(after - target):
            cuts.append(float(middle[i]))
            target += stride
    return cuts


def _cuts(rows: int, splits: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(feature, thresholds) from the sorted (feature, value, n) of whole features."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        feature, value, n = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("feature", "value", "n"))
        edges = np.r_[np.flatnonzero(np.r_[True, np.diff(feature) != 0]), len(feature)]
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            values, weights = value[a:b], n[a:b]
            zeros = rows - weights.sum()
            if zeros > 0:
                place = np.searchsorted(values, 0.0)
                values, weights = np.insert(values, place, 0.0), np.insert(weights, place, zeros)
            out.append(thresholds_between(values, weights, splits))
        yield pa.RecordBatch.from_pydict({"feature": pa.array(feature[edges[:-1]], pa.int32()), "thresholds": pa.array(out, pa.list_(pa.float64()))})

    return cut


def _encode(shared: Broadcast):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per block: its number, its rows, the codes of their entries side by side, and their labels."""
        bins, labels, lines, block = Bins(*shared.value), [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            block = b.column("block")[0].as_py()
            label, many, feature, value = _entries(b)
            line = np.full((len(label), max(1, int(many.max()))), bins.cells, bins.code_type)
            row = np.repeat(np.arange(len(label)), many)
            line[row, np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)] = bins.codes(feature, value)
            labels.append(label)
            lines.append(line)
        if lines:
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "codes": [_beside(lines, bins).T.tobytes()], "labels": [np.concatenate(labels).tobytes()]}
            )

    return encode


def _beside(lines: list[np.ndarray], bins: Bins) -> np.ndarray:
    """Rows of codes one below the other, as wide as the widest; the code behind the last cell fills up."""
    out = np.full((sum(map(len, lines)), max(x.shape[1] for x in lines)), bins.cells, bins.code_type)
    at = 0
    for x in lines:
        out[at : at + len(x), : x.shape[1]] = x
        at += len(x)
    return out


@dataclass
class Binned:
    """Training rows as bins: blocks of (number, (codes, labels)), each in the task that will sum it."""

    blocks: RDD
    bins: Bins
    tasks: int
    width: int
    rows: int
    unit: float
    label: str
    features: str
    cached: DataFrame

    @property
    def sparkSession(self):
        return self.cached.sparkSession

    def __enter__(self) -> Binned:
        return self

    def __exit__(self, *_):
        self.blocks.unpersist()


def binned(train: DataFrame, label: str, features: str = "features", max_bins: int = 32) -> Binned:
    """Bins of ``train``, which should be persisted: it is read three times. Its partitions are the blocks of the bootstrap."""
    spark = train.sparkSession
    y, vector = F.col(label).cast("double"), F.unwrap_udt(F.col(features))
    rows = train.select(F.spark_partition_id().alias("block"), y.alias("label"), vector.alias("vector"))
    infinite = lambda v: F.isnan(v) | (F.abs(v) == float("inf"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label").isNull() | infinite(F.col("label"))).alias("bad_labels"),
        F.count_if(F.col("vector").isNull() | F.exists(F.col("vector.values"), infinite)).alias("bad_vectors"),
        F.max(F.coalesce(F.col("vector.size"), F.size("vector.values"))).alias("width"),
        F.sum(F.abs(F.col("label"))).alias("size"),
        F.max(F.abs(F.col("label"))).alias("largest"),
        F.max("block").alias("block"),
    ).first()
    if not facts["rows"]:
        raise ValueError("a forest needs training rows")
    if facts["bad_labels"] or facts["bad_vectors"]:
        raise ValueError(f"{facts['bad_labels']} labels and {facts['bad_vectors']} vectors are missing, NaN or infinite")

    splits = min(max_bins, facts["rows"]) - 1
    values = rows.select("label", "vector").mapInArrow(_describe, "feature int, value double, n long")
    values = values.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    sorted_values = values.repartition("feature").sortWithinPartitions("feature", "value")
    found = {r["feature"]: r["thresholds"] for r in sorted_values.mapInArrow(_cuts(facts["rows"], splits), "feature int, thresholds array<double>").collect()}
    cuts = [found.get(f, []) for f in range(facts["width"])]
    bins = Bins(np.array([t for c in cuts for t in c], float), np.r_[0, np.cumsum([len(c) + 1 for c in cuts])].astype(np.int64))

    sc = spark.sparkContext
    shared, blocks, cores = sc.broadcast((bins.thresholds, bins.starts)), facts["block"] + 1, sc.defaultParallelism
    # As many tasks as cores, or a multiple; sums are whole, so the forest does not depend on their number.
    tasks = min(blocks, cores * -(-max(1, -(-facts["rows"] // ROWS_PER_TASK)) // cores))
    encoded = rows.mapInArrow(_encode(shared), "block int, codes binary, labels binary").rdd
    placed = encoded.map(lambda r: (r[0], (bytes(r[1]), bytes(r[2])))).partitionBy(tasks, lambda block: block * tasks // blocks)
    # Labels are summed in units: a power of two that keeps every sum a whole number below the bound.
    most = max(2 * facts["size"], 64 * facts["largest"], sys.float_info.min)
    unit = 2.0 ** (math.ceil(math.log2(most)) - SUM_BITS)
    kept = placed.persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(kept, bins, tasks, facts["width"], facts["rows"], unit, label, features, train)


def node_type(nodes: int) -> type:
    return np.uint8 if nodes < 255 else np.uint16 if nodes < 65_535 else np.uint32


def _started(shared: Broadcast):
    def start(held: Iterable[tuple[int, tuple[bytes, bytes]]]) -> Iterator[tuple]:
        """The rows of a task, then one record per tree: how often it draws each row, and the row's node."""
        growth = Growth.of(shared)
        bins, blocks = growth.bins, sorted(held)
        if not blocks:
            return
        labels = [np.frombuffer(y) for _, (_, y) in blocks]
        lines = [np.frombuffer(codes, bins.code_type).reshape(-1, len(y)).T for (_, (codes, _)), y in zip(blocks, labels)]
        label = np.concatenate(labels)
        yield "rows", np.ascontiguousarray(_beside(lines, bins).T), label
        for tree in range(growth.trees):
            draws = [np.random.default_rng([growth.seed & (1 << 63) - 1, tree, number]).poisson(1.0, len(y)) for (number, _), y in zip(blocks, labels)]
            weights = np.concatenate(draws).astype(np.uint8) if growth.bootstrap else np.ones(len(label), np.uint8)
            yield tree, weights, np.where(weights > 0, 0, 255).astype(np.uint8)

    return start


def _moved(shared: Broadcast, tables: Broadcast):
    def move(records: Iterable[tuple]) -> Iterator[tuple]:
        """Every row of a node that was split goes to a child; rows of leaves leave their tree."""
        records = iter(records)
        rows = next(records, None)
        if rows is None:
            return
        yield rows
        codes = rows[1]
        for tree, weights, nodes in records:
            children, first, length, default, base = tables.value[tree]
            kind = node_type(children)
            out = np.full(len(nodes), np.iinfo(kind).max, kind)
            live = np.flatnonzero(nodes != np.iinfo(nodes.dtype).max)
            live = live[base[nodes[live]] >= 0]
            node = nodes[live]
            a, n = first[node], length[node]
            other = np.zeros(len(live), bool)
            for column in codes:
                other |= (column[live] - a) < n  # unsigned: below the range is far above it
            out[live] = base[node] + (default[node] == other)
            yield tree, weights, out

    return move


def feature_mask(growth: Growth, tree: int, depth: int, chunk: int, nodes: int) -> np.ndarray | None:
    """Which features each node may split on; None stands for all."""
    features = len(growth.bins.starts) - 1
    if growth.per_node >= features:
        return None
    score = np.random.default_rng([growth.seed & (1 << 63) - 1, tree, depth, chunk]).random((nodes, features), np.float32)
    mask = np.zeros((nodes, features), bool)
    np.put_along_axis(mask, np.argpartition(score, growth.per_node - 1, axis=1)[:, : growth.per_node], True, axis=1)
    return mask


def _tables(rows: tuple, weights: np.ndarray, nodes: np.ndarray, at: np.ndarray, first: int, size: int, stride: int) -> list[np.ndarray]:
    """The rows ``at`` added up, a strip at a time, so that what is worked on stays in the core's memory.

    Per node from ``first`` on: weights, labels in units, labels, squares. Per
    node and cell, if there is a ``stride``: weights and labels in units.
    """
    codes, label, whole = rows
    out: list[np.ndarray] = []
    step = max(STRIP, size * stride // 4)
    for start in range(0, len(at), step):
        part = at[start : start + step]
        node, w, y = nodes[part].astype(np.int64) - first, weights[part].astype(float), label[part]
        units = w * whole[part]
        found = [np.bincount(node, v, size) for v in (w, units, w * y, w * y * y)]
        if stride:
            key = (np.take(codes, part, axis=1) + node * stride).ravel()
            found += [np.bincount(key, np.broadcast_to(v, (len(codes), len(v))).ravel(), size * stride) for v in (w, units)]
        out = [np.add(x, y, out=x) for x, y in zip(out, found)] if out else found
    return out


def _summed(shared: Broadcast, active: dict[int, int], depth: int, split: bool):
    def add_up(records: Iterable[tuple]) -> Iterator[tuple]:
        """((tree, chunk), (per node: weights, labels in units, labels, squares; per cell: weights, labels in units))."""
        growth = Growth.of(shared)
        records = iter(records)
        rows = next(records, None)
        if rows is None:
            return
        _, codes, label = rows
        own, stride = (codes, label, np.rint(label / growth.unit)), (growth.bins.cells + 1) * split
        for tree, weights, nodes in records:
            count = active.get(tree, 0)
            live = np.flatnonzero(nodes != np.iinfo(nodes.dtype).max)
            if not count or not len(live):
                continue
            chunks = -(-count // growth.chunk)
            if chunks > 1:
                live = live[np.argsort(nodes[live], kind="stable")]
            edges = np.searchsorted(nodes[live], np.arange(chunks) * growth.chunk) if chunks > 1 else [0]
            for number, (start, stop) in enumerate(zip(edges, [*edges[1:], len(live)])):
                at = live[start:stop]
                if not len(at):
                    continue
                size = min(growth.chunk, count - number * growth.chunk)
                tables = _tables(own, weights, nodes, at, number * growth.chunk, size, stride)
                per_node, cells = tables[:4], tables[4:]
                if split:
                    mask = feature_mask(growth, tree, depth, number, size)
                    kept = slice(None) if mask is None else mask[:, growth.bins.feature]
                    cells = [c.reshape(size, stride)[:, :-1][kept].ravel() for c in cells]
                yield (tree, number), (_packed(per_node), _packed(cells) if split else None)

    return add_up


def _packed(tables: list[np.ndarray]) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """(places, values) where few places of ``tables`` hold a weight, the first table, else (None, tables)."""
    at = np.flatnonzero(tables[0])
    return (None, tables) if 2 * len(at) > len(tables[0]) else (at.astype(np.int32), [t[at] for t in tables])


def _spread(packed: tuple[np.ndarray | None, list[np.ndarray]], size: int) -> list[np.ndarray]:
    at, tables = packed
    return tables if at is None else [np.bincount(at, t, size) for t in tables]


def _joined(a: tuple | None, b: tuple | None) -> tuple | None:
    """The sum of two packed lists of tables."""
    if a is None or b is None:
        return a or b
    if a[0] is not None and b[0] is not None:
        return np.concatenate([a[0], b[0]]), [np.concatenate(pair) for pair in zip(a[1], b[1])]
    size = len((a if a[0] is None else b)[1][0])
    return None, [x + y for x, y in zip(_spread(a, size), _spread(b, size))]


def _added(a: tuple, b: tuple) -> tuple:
    return tuple(map(_joined, a, b))


def _best(shared: Broadcast, active: dict[int, int], depth: int, split: bool):
    def best(item: tuple) -> tuple:
        """(tree, chunk, weight, sum, squares, cell of the best split or -1, gain) of the nodes of a chunk."""
        growth = Growth.of(shared)
        (tree, number), (per_node, packed) = item
        size = min(growth.chunk, active[tree] - number * growth.chunk)
        w, whole, y, square = _spread(per_node, size)
        if not split:
            return tree, number, w, y, square, np.full(size, -1), np.full(size, -1.0)
        bins, mask = growth.bins, feature_mask(growth, tree, depth, number, size)
        allowed = np.ones((size, bins.cells), bool) if mask is None else mask[:, bins.feature]
        cells = _spread(packed, int(allowed.sum()))
        left = []
        for total, found in zip((w, whole), cells):
            table = np.zeros((size, bins.cells))
            table[allowed] = found
            # What has no entry lies in the bin of zero.
            table[:, bins.zero] += total[:, None] - np.add.reduceat(table, bins.starts[:-1], axis=1)
            left.append(np.cumsum(table, axis=1) - bins.feature * total[:, None])
        (n, s), of, whole = left, w[:, None], whole[:, None]
        fits = allowed & ~bins.last & (n >= growth.min_leaf) & (of - n >= growth.min_leaf) & (n > 0) & (of > n)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(fits, s * s / n + (whole - s) ** 2 / (of - n), -np.inf)
        cell = score.argmax(axis=1)
        base = whole[:, 0] ** 2 / w
        more = score[np.arange(size), cell] - base
        good = more > NOISE * base
        return tree, number, w, y, square, np.where(good, cell, -1), np.where(good, more / w * growth.unit**2, -1.0)

    return best


def _table(bins: Bins, cell: np.ndarray, dtype: type) -> tuple:
    """(children, first cell and number of cells that go the other way, whether zero goes left, first child) of every node."""
    split = cell >= 0
    feature = bins.feature[cell]
    lo, hi = bins.starts[feature], bins.starts[feature + 1]
    left = bins.zero[feature] <= cell
    base = np.where(split, 2 * (np.cumsum(split) - 1), -1)
    return 2 * int(split.sum()), np.where(left, cell + 1, lo).astype(dtype), np.where(left, hi - cell - 1, cell - lo + 1).astype(dtype), left, base


def grown(table: Binned, trees: int, depth: int, min_leaf: int, seed: int, per_node: int, bootstrap: bool) -> list[dict[str, np.ndarray]]:
    """The nodes of every tree, level by level, children behind their parents."""
    sc, bins, sent = table.blocks.context, table.bins, []
    growth = sc.broadcast(Growth(bins, trees, per_node, min_leaf, seed, table.unit, bootstrap).plain())
    state = table.blocks.mapPartitions(_started(growth)).persist(StorageLevel.MEMORY_AND_DISK)
    active, levels, before = {t: 1 for t in range(trees)}, [[] for _ in range(trees)], None
    for level in range(depth + 1):
        split = level < depth
        sums = state.mapPartitions(_summed(growth, active, level, split)).reduceByKey(_added, table.tasks)
        found: dict[int, list] = {}
        for tree, *part in sums.map(_best(growth, active, level, split)).collect():
            found.setdefault(tree, []).append(part)
        tables = {t: (0, *[np.zeros(1, bins.code_type)] * 2, np.zeros(1, bool), np.full(1, -1)) for t in range(trees)}
        for tree, parts in found.items():
            n, total, square, cell, gain = (np.concatenate(x) for x in list(zip(*sorted(parts, key=lambda p: p[0])))[1:])
            tables[tree] = _table(bins, cell, bins.code_type)
            levels[tree].append({"n": n, "sum": total, "square": square, "cell": cell, "gain": gain, "child": tables[tree][4]})
        active = {t: tables[t][0] for t in found if tables[t][0]}
        if before is not None:
            before.unpersist()
        if not active:
            break
        sent.append(sc.broadcast(tables))
        before, state = state, state.mapPartitions(_moved(growth, sent[-1])).persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    # Only now: until here a lost part may be computed again.
    for shared in (growth, *sent):
        shared.destroy()
    # A tree whose bootstrap draws no row predicts 0, as in Spark ML.
    nothing = {"n": np.zeros(1), "sum": np.zeros(1), "square": np.zeros(1), "cell": np.full(1, -1), "gain": np.full(1, -1.0), "child": np.full(1, -1)}
    out = []
    for parts in (p or [nothing] for p in levels):
        behind = np.cumsum([len(p["n"]) for p in parts])
        for part, end in zip(parts, behind):
            part["child"] = np.where(part["child"] >= 0, part["child"] + end, -1)
        out.append({k: np.concatenate([p[k] for p in parts]) for k in parts[0]})
    return out


def _facts(kind: str, uid: str, instance, of, **more) -> str:
    """Description of a stored model: the parameters that were set, and the defaults."""
    known = {p.name for p in of.params}
    maps = {
        name: {p.name: v for p, v in values.items() if p.name in known}
        for name, values in (("paramMap", instance._paramMap), ("defaultParamMap", instance._defaultParamMap))
    }
    head = {"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "uid": uid}
    return json.dumps(head | maps | more)


def stored_model(table: Binned, forest: RandomForestRegressor, nodes: list[dict[str, np.ndarray]]) -> RandomForestRegressionModel:
    """The forest as a Spark ML model, by way of a folder in the layout in which Spark ML stores one."""
    spark, bins = table.sparkSession, table.bins
    path = scratch_path(spark, "forest")
    version = {"sparkVersion": spark.version}
    whole = _facts("RandomForestRegressionModel", forest.uid, forest, forest, numFeatures=table.width, numTrees=len(nodes), **version)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    single = DecisionTreeRegressor()
    trees = [(t, _facts("DecisionTreeRegressionModel", f"{single.uid}_{t}", forest, single, **version), 1.0) for t in range(len(nodes))]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")

    n, total, square, cell, gain, child = (np.concatenate([t[k] for t in nodes]) for k in ("n", "sum", "square", "cell", "gain", "child"))
    sizes = [len(t["n"]) for t in nodes]
    inner, mean = cell >= 0, total / np.maximum(n, 1)
    feature = np.where(inner, bins.feature[cell], -1)
    # The threshold behind cell c of feature f: one less per feature before it.
    cut = bins.thresholds[(cell - feature)[inner]]
    leaf_lists = lambda flat, many: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()), pa.array(flat))
    i32 = lambda v: pa.array(v, pa.int32())
    splits = pa.StructArray.from_arrays(
        [i32(feature), leaf_lists(cut, inner), i32(np.full(len(n), -1))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"]
    )
    data = {
        "id": i32(np.concatenate([np.arange(s) for s in sizes])),
        "prediction": pa.array(mean),
        "impurity": pa.array(np.maximum(square / np.maximum(n, 1) - mean**2, 0.0)),
        "impurityStats": leaf_lists(np.stack([n, total, square], axis=1).ravel(), np.full(len(n), 3)),
        "rawCount": pa.array(n.astype(np.int64)),
        "gain": pa.array(gain),
        "leftChild": i32(child),
        "rightChild": i32(np.where(inner, child + 1, -1)),
        "split": splits,
    }
    rows = pa.table({"treeID": i32(np.repeat(np.arange(len(nodes)), sizes)), "nodeData": pa.StructArray.from_arrays(list(data.values()), list(data))})
    spark.createDataFrame(rows).write.parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def fit(table: Binned, forest: RandomForestRegressor) -> RandomForestRegressionModel:
    """Fit what ``forest`` asks for over ``table``: its trees, depth, rows of a leaf and seed."""
    trees, depth, least = (forest.getOrDefault(p) for p in ("numTrees", "maxDepth", "minInstancesPerNode"))
    per_node = table.width if trees == 1 else -(-table.width // 3)
    nodes = grown(table, trees, depth, least, forest.getOrDefault("seed"), per_node, forest.getOrDefault("bootstrap"))
    return stored_model(table, forest, nodes)
