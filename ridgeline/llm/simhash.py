"""SimHash near-duplicates: fingerprints, block join, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import LOWER
from ridgeline.llm.components import components, local_roots
from ridgeline.sources.scratch import staged

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time; bounds a task's memory for very long texts.
PIECE = 1 << 16
#: Fingerprints of a bucket that meet in one tile; larger buckets are cut into pairs of such tiles.
TILE = 2048


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the bits of the hashes of all shingles, repeats included; 0 without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), PIECE):
        part = hashes[at : at + PIECE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    ids = F.col(id_col).cast("long").alias("doc_id")
    return docs.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(max_bits: int, spare: int = 2) -> list[int]:
    """Masks of which two fingerprints within ``max_bits`` agree on at least one.

    The bits are cut into ``max_bits + spare`` blocks. At most ``max_bits``
    blocks differ, so ``spare`` of them are equal: one mask per choice of that
    many. More spare blocks mean longer keys and fewer chance meetings.
    """
    n = max_bits + spare
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(blocks, spare)]


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: compare within buckets, return the local components' edges."""
    rest: list[np.ndarray] | None = None
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def flushed():
        if not found:
            return
        a, b = local_roots(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
        found.clear()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

    def compare(key, fp, rep):
        fp, size = fp.view(np.uint64), 0  # bits are counted of the absolute value of a signed number
        for lag in range(1, len(key)):
            same = np.flatnonzero(key[lag:] == key[:-lag])
            if not len(same):
                break
            near = same[np.bitwise_count(fp[same] ^ fp[same + lag]) <= max_bits]
            if len(near):
                found.append((rep[near], rep[near + lag]))
                size += len(near)
                if size > 1_000_000:
                    found[:] = [local_roots(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))]
                    size = 0
        return size

    held = 0
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if rest is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(rest, cols)]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        held += compare(*(c[:cut] for c in cols))
        rest = [c[cut:] for c in cols]
        if held > 1_000_000:
            yield from flushed()
            held = 0
    if rest is not None:
        compare(*rest)
    yield from flushed()


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``u, v`` between the ids of fingerprints at most ``max_bits`` apart.

    ``classes`` has one row ``fp, rep`` per distinct fingerprint. Every such
    pair meets in a bucket and is compared; of the pairs found in one task only
    a spanning forest is returned. A bucket larger than TILE is cut by hash
    into parts, and every pair of parts is a task-sized bucket of its own.
    """
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(block_masks(max_bits))]
    rows = classes.select("fp", "rep", F.explode(F.array(*keys)).alias("key"))
    large = staged(rows.groupBy("key").count().filter(F.col("count") > TILE), "buckets")
    parts = F.ceil(F.coalesce("count", F.lit(1)) / TILE).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    tiles = (
        rows.join(large, "key", "left")
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"), "fp", "rep")
    )
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        tiles.repartition(n, "tile")
        .sortWithinPartitions("tile")
        .mapInArrow(lambda batches: _linked(batches, max_bits), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Words are runs of bytes other than white space, A-Z lower-cased. Documents
    link at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest id reachable. Equal fingerprints are one node from the start, so
    exact copies, however many, cost one row.

    NULL and empty texts have fingerprint zero and link like any other. A NULL
    id never names a component but its row is returned; repeated ids give
    repeated rows. An empty table gives an empty result.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes.filter("rep is not null"), max_bits))
    named = staged(
        classes.join(roots, classes["rep"] == roots["node"], "left").select("fp", F.coalesce("root", "rep").alias("component_id")),
        "named",
    )
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
