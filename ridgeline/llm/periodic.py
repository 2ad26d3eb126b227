"""Periodic runs of words, found by asking where dyadic blocks occur again.

A block of 2^k words that lies in a run of period q, with 2^(k-1) < q <= 2^k,
occurs again q words later and not before. So for every k the blocks on a grid
ask a wavelet tree over the suffix array for their next occurrence; where it is
at most 2^k words away, the block, it and what follows in the same step form a
progression, whose step is the candidate period. Extending both ways gives the run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that are worked on at a time; a longer text is a group of its own.
GROUP = 1 << 18
#: A run has at least this many words, and this many times its period.
SHORTEST, TIMES = 6, 4
#: Blocks start at multiples of 4, or of half their length where that is more: then the first
#: block of a run of 4 periods, and its next occurrence, lie inside the run for every period.
STEP = 4


def bucket_starts(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """For k = 0, 1, ...: per position, how many suffixes have a smaller prefix of 2^k codes.

    Positions with equal values start the same 2^k codes. Doubling ends when all
    values differ, or when 2^k exceeds ``longest``, beyond which nothing repeats.
    """
    n = len(codes)
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    low = (np.cumsum(counts) - counts)[inverse]
    levels = [low.astype(np.int32)]
    step = 1
    while step <= longest:
        open_ = np.flatnonzero(np.bincount(low, minlength=n)[low] > 1)
        if not len(open_):
            break
        beyond = open_ + step
        second = np.where(beyond < n, low[np.minimum(beyond, n - 1)] + 1, 0)
        key = low[open_] * (n + 1) + second
        by = np.argsort(key)
        key, at = key[by], open_[by]
        old = low[at]
        place = np.arange(len(at))
        first_old = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), place, 0))
        first_new = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), place, 0))
        low = low.copy()
        low[at] = old + first_new - first_old
        levels.append(low.astype(np.int32))
        step *= 2
    return levels


class WaveletTree:
    """Range successor over an array that holds each of 0 .. n-1 once."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length())
        self.zeros: list[np.ndarray] = []  # per bit: how many zeros stand before each place
        now = values
        for bit in range(self.bits - 1, -1, -1):
            one = (now >> bit & 1).astype(bool)
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            now = np.concatenate([now[~one], now[one]])

    def successor(self, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Per query the smallest value greater than ``above`` at places ``low`` to ``high - 1``; n if there is none."""
        least = np.minimum(above + 1, self.n - 1)
        l, h, smaller = low, high, np.zeros(len(low), np.int64)
        for level, before in enumerate(self.zeros):
            one = (least >> (self.bits - 1 - level) & 1).astype(bool)
            zl, zh = before[l], before[h]
            smaller += np.where(one, zh - zl, 0)
            l, h = np.where(one, before[-1] + l - zl, zl), np.where(one, before[-1] + h - zh, zh)
        out = np.full(len(low), self.n, np.int64)
        there = np.flatnonzero((smaller < high - low) & (above + 1 < self.n))
        l, h, rest, value = low[there], high[there], smaller[there], np.zeros(len(there), np.int64)
        for before in self.zeros:
            zl, zh = before[l], before[h]
            zero = rest < zh - zl
            rest = np.where(zero, rest, rest - (zh - zl))
            value = value * 2 + ~zero
            l, h = np.where(zero, zl, before[-1] + l - zl), np.where(zero, zh, before[-1] + h - zh)
        out[there] = value
        return out


def _extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many codes from ``a`` and ``b`` (a < b) on agree, and how many before them."""
    i, j = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        size, low = 1 << k, levels[k]
        # Whole blocks may agree several times on the highest level only.
        while True:
            inside = j + size <= n
            same = inside & (low[np.minimum(i, n - 1)] == low[np.minimum(j, n - 1)])
            i, j = i + same * size, j + same * size
            if k < len(levels) - 1 or not same.any():
                break
    back = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size, low = 1 << k, levels[k]
        while True:
            p = a - back - size
            same = (p >= 0) & (low[np.maximum(p, 0)] == low[np.maximum(b - back - size, 0)])
            back += same * size
            if k < len(levels) - 1 or not same.any():
                break
    return i - a, back


def runs_of(codes: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period.

    Codes of different texts must differ; ``longest`` is the length of the longest text.
    """
    n = len(codes)
    found: list[np.ndarray] = []
    if n:
        levels = bucket_starts(codes, longest)
        suffixes = np.argsort(levels[-1], kind="stable")
        tree = WaveletTree(suffixes)
        for k, low in enumerate(levels):
            block = np.arange(0, n, max(STEP, 1 << k >> 1))
            at = low[block].astype(np.int64)
            high = at + np.bincount(low, minlength=n)[at]
            again = high - at > 1
            block, at, high = block[again], at[again], high[again]
            if not len(block):
                continue
            period = tree.successor(at, high, block) - block
            near = (period <= 1 << k) & (2 * period > 1 << k) & (block + period < n)
            block, period = block[near], period[near]
            forward, back = _extended(levels, block, block + period, n)
            length = back + period + forward
            is_run = length >= np.maximum(SHORTEST, TIMES * period)
            found.append(np.stack([block - back, length, period], axis=1)[is_run])
    rows = np.unique(np.concatenate([np.zeros((0, 3), np.int64), *found]), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; the smallest start, then period, among equals."""
    if not runs:
        return None
    most = max(length / period for _, length, period in runs)
    close = [r for r in runs if r[1] / r[2] >= most * (1 - 1e-12)]
    return min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def words_of(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text, cut at ASCII white space."""
    return (text or "").encode().split()


def looped(doc_id: int | None, text: str | None) -> list[bytes]:
    """Words of a text; one text in ten, by the crc32 of its id, repeats a stretch from a place on."""
    words = words_of(doc_id, text)
    if words and doc_id is not None:
        by, place = zlib.crc32(str(doc_id).encode()), 0
        if by % 10 == 0:
            by //= 10
            place = by % len(words)
            stretch = words[place : place + 1 + (len(words) - place) // (3 + by % 8)]
            words = words[:place] + (stretch * (len(words) // len(stretch) + 1))[: len(words) - place]
    return words


def _groups(batch: pa.RecordBatch, words: Callable) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each row) of consecutive rows that together have about GROUP words."""
    held: list[list[bytes]] = []
    first = size = 0
    for row, (doc_id, text) in enumerate(zip(batch.column(0), batch.column(1))):
        held.append(words(doc_id.as_py(), text.as_py()))
        size += len(held[-1])
        if size >= GROUP:
            yield first, held
            first, size, held = row + 1, 0, []
    if held:
        yield first, held


def _group_runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts, with starts counted over all of them, and where each text begins."""
    flat = [w for words in texts for w in words]
    number = {w: i for i, w in enumerate(set(flat))}
    codes = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    sizes = np.array([len(words) for words in texts], np.int64)
    codes += np.repeat(np.arange(len(texts)) * len(number), sizes)
    return runs_of(codes, int(sizes.max(initial=0))), np.cumsum(sizes) - sizes


def detected(
    docs: DataFrame,
    words: Callable[[int | None, str | None], list[bytes]] = words_of,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, runs, strongest, collapsed`` for every row, from whole texts and without a shuffle.

    ``runs`` are structs (start, length, period) in words, by start, then
    period; ``strongest`` is the one with the most periods, NULL without a run;
    ``collapsed`` is the text without the words that a run repeats: what any
    run contains after its first period goes, the rest is joined by one blank.
    ``words`` cuts a text into words.

    NULL and empty texts have no word: no run and an empty ``collapsed``. Ids
    repeated or NULL come back as they are; other columns are not read; an
    empty table gives an empty result. Memory follows the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        names = ["start", "length", "period"]
        for batch in batches:
            for first, texts in _groups(batch, words):
                rows, begins = _group_runs(texts)
                cuts = np.searchsorted(rows[:, 0], np.append(begins, begins[-1] + len(texts[-1])))
                rows[:, 0] -= np.repeat(begins, np.diff(cuts))
                tuples = list(map(tuple, rows.tolist()))
                best, collapsed = [], []
                for kept, lo, hi in zip(texts, cuts.tolist(), cuts[1:].tolist()):
                    best.append(strongest(tuples[lo:hi]))
                    if hi > lo:
                        dropped = np.zeros(len(kept) + 1, np.int64)
                        np.add.at(dropped, rows[lo:hi, 0] + rows[lo:hi, 2], 1)
                        np.add.at(dropped, rows[lo:hi, 0] + rows[lo:hi, 1], -1)
                        kept = [kept[i] for i in np.flatnonzero(np.cumsum(dropped)[:-1] == 0)]
                    collapsed.append(b" ".join(kept).decode())
                spans = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], names=names)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans),
                        pa.array([b and dict(zip(names, b)) for b in best], struct),
                        pa.array(collapsed, pa.string()),
                    ],
                    names=["doc_id", "runs", "strongest", "collapsed"],
                )

    span = "struct<start: long, length: long, period: long>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, runs array<{span}>, strongest {span}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the strongest one, and digests of the runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
