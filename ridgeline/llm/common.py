"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def crc_bucket(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % buckets


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch as tuples."""
    return zip(*(c.to_pylist() for c in batch.columns))


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def runs(texts: Iterable[str | None], pattern, size: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The matches of ``pattern`` in every text, as groups of (number of the text, matches).

    A group holds about ``size`` matches: several short texts, or a part of a
    long one, whose matches then go on in the next group.
    """
    held: list[tuple[int, list[str]]] = []
    n = 0
    for row, text in enumerate(texts):
        if not text:
            continue
        if len(text) < size:
            parts: Iterable[list[str]] = (pattern.findall(text),)
        else:
            found = (m.group() for m in pattern.finditer(text))
            parts = iter(lambda found=found: list(islice(found, size)), [])
        for part in parts:
            held.append((row, part))
            n += len(part)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


class DistinctTable:
    """The ids of every distinct piece of text, found once and looked up by number afterwards.

    ``segment`` gives the ids of new pieces, one sequence each. When the table
    holds ``bound`` pieces it starts anew, so memory is bounded.
    """

    def __init__(self, segment: Callable[[list[str]], Iterable[Sequence[int]]], bound: int):
        self.segment, self.bound = segment, bound
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in their order, and how many each piece has."""
        if len(self.number) > self.bound:
            self._clear()
        new = list(set(pieces).difference(self.number))
        for piece, ids in zip(new, self.segment(new)):
            self.number[piece] = len(self.number)
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        at = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        ends = np.frombuffer(self.ends, np.int64)
        return slices(np.frombuffer(self.flat, np.uintc), ends[:-1], np.diff(ends), at)


def slices(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices number ``at`` of ``flat`` one after the other, and their lengths."""
    sizes = lengths[at]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) + np.repeat(starts[at] - ends + sizes, sizes)
    return flat[place], sizes


class Digests:
    """Per text: number of ids, digest of the ids, digest of the decoded bytes."""

    def __init__(self, rows: int):
        self.n = [0] * rows
        self.ids = [hashlib.sha256() for _ in range(rows)]
        self.bytes = [hashlib.sha256() for _ in range(rows)]

    def add(self, row: int, ids: np.ndarray, raw: np.ndarray) -> None:
        self.n[row] += len(ids)
        self.ids[row].update(ids.astype("<u4", copy=False))
        self.bytes[row].update(raw)

    def arrays(self) -> list[pa.Array]:
        hexes = [[h.hexdigest() for h in hashes] for hashes in (self.ids, self.bytes)]
        return [pa.array(self.n, pa.int64()), *(pa.array(x, pa.string()) for x in hexes)]
