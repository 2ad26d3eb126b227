"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import Digests, DistinctTable, runs, slices

#: Pre-tokens that are looked up at a time, and distinct ones that a worker remembers.
PIECES = 1 << 17
REMEMBERED = 600_000
#: Texts that are encoded at a time, so that a worker holds the ids and digests of few.
ROWS = 512


class MinimalPerfectHash:
    """A bijection from ``n`` byte strings to 0 .. n-1.

    Level by level, keys that fall alone into a bit of a table twice their
    number are settled there; the others go to the next level. A key's number
    is the count of set bits before its own. Strings outside the set get a
    number too, or -1, so the caller compares the key kept under the number.
    """

    def __init__(self, keys: list[bytes]):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left = self.hashes(keys)
        if len(np.unique(left)) != len(left):
            raise ValueError("two keys have the same 64-bit hash")
        before = 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._slot(left, size, len(self.levels))
            alone = np.bincount(at, minlength=size) == 1
            number = before + np.cumsum(alone) - 1
            self.levels.append((size, alone, number))
            before += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    @staticmethod
    def _slot(hashes: np.ndarray, size: int, level: int) -> np.ndarray:
        mixed = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of each key, -1 for some that are not in the set."""
        hashes = self.hashes(keys)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, alone, number) in enumerate(self.levels):
            at = self._slot(hashes[left], size, level)
            hit = alone[at]
            out[left[hit]] = number[at[hit]]
            left = left[~hit]
        return out


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """``left << 32 | right`` to the id of the joined token, for every split of every token."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    return pairs


def merge(piece: bytes, byte_ids: list[int], pairs: dict[int, int]) -> tuple[int, ...]:
    """Ids of one pre-token: the lowest-ranked adjacent pair is joined first, the leftmost among equals.

    The parts are a linked list over byte positions; a heap holds the pairs
    that can be joined as rank and position in one number, and an entry whose
    pair has changed since is skipped.
    """
    n = len(piece)
    ids = [byte_ids[b] for b in piece]
    after = list(range(1, n + 1))
    prior = list(range(-1, n - 1))
    get = pairs.get
    open_ = [get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]
    open_.append(-1)
    bits = n.bit_length()
    place = (1 << bits) - 1
    heap = [r << bits | i for i, r in enumerate(open_) if r >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i, rank = entry & place, entry >> bits
        if open_[i] != rank:
            continue
        gone = after[i]
        k = after[i] = after[gone]
        ids[i], open_[gone] = rank, -1
        r = -1
        if k < n:
            prior[k] = i
            if (r := get(rank << 32 | ids[k], -1)) >= 0:
                push(heap, r << bits | i)
        open_[i] = r
        if (p := prior[i]) >= 0:
            r = open_[p] = get(ids[p] << 32 | rank, -1)
            if r >= 0:
                push(heap, r << bits | p)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return tuple(out)


class Codec:
    """Encoder and decoder over a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} has no rank for the bytes {missing}")
        self.pattern = regex.compile(pattern)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        self.pairs = pair_table(self.ranks)
        keys = list(self.ranks)
        self.mph = MinimalPerfectHash(keys)
        self.slots: list[bytes] = [b""] * len(keys)
        for k, s in zip(keys, self.mph.find(keys).tolist()):
            self.slots[s] = k
        self.slot_ids = [(self.ranks[k],) for k in self.slots]
        # One entry per id up to the largest; ids without a token have no bytes.
        raw = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        self.table = DistinctTable(self.segments, REMEMBERED)

    def segments(self, pieces: list[str]) -> Iterator[tuple[int, ...]]:
        """Ids of every pre-token: first tier by hash, the misses by merging."""
        raw = [p.encode() for p in pieces]
        for key, slot in zip(raw, self.mph.find(raw).tolist()):
            whole = slot >= 0 and self.slots[slot] == key
            yield self.slot_ids[slot] if whole else merge(key, self.byte_ids, self.pairs)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids of its next part) in order, for many texts at a time."""
        for group in runs(texts, self.pattern, PIECES):
            ids, sizes = self.table.ids_of([p for _, part in group for p in part])
            cuts = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0] + [len(part) for _, part in group])]
            for (row, _), lo, hi in zip(group, cuts, cuts[1:]):
                yield row, ids[lo:hi]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``."""
        return slices(self.raw, self.raw_start, self.raw_length, ids.astype(np.int64))[0]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path, pattern)


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text and decode it again, without a shuffle.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256, decodes`` (whether the decoded bytes are
    the text's), and with ``with_ids`` also ``ids`` (array of int). ``path`` must exist on every
    executor. A NULL text counts as empty: no tokens, the digests of nothing. One row per input row,
    ids repeated or NULL as they come; an empty table gives an empty result.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decodes"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decodes boolean"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            texts = batch.column(1).to_pylist()
            done = Digests(len(texts))
            kept: list[list[np.ndarray]] = [[] for _ in texts] if with_ids else []
            for row, ids in c.encode(texts):
                done.add(row, ids, c.decode(ids))
                if with_ids:
                    kept[row].append(ids.astype(np.int32))
            arrays = [batch.column(0), *done.arrays()]
            same = [h.digest() == hashlib.sha256((t or "").encode()).digest() for h, t in zip(done.bytes, texts)]
            arrays.append(pa.array(same, pa.bool_()))
            if with_ids:
                ends = pa.array(np.cumsum([0] + done.n).astype(np.int32))
                whole = np.concatenate([x for parts in kept for x in parts] + [np.zeros(0, np.int32)])
                arrays.append(pa.ListArray.from_arrays(ends, pa.array(whole)))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    ids = F.col(id_col).cast("long").alias("doc_id")
    return docs.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
