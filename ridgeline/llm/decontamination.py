"""Benchmark decontamination: positional postings, intersected from the rarest term."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import fresh
from ridgeline.sources.scratch import staged

#: Words are runs of digits, letters and bytes above 127; A-Z become a-z.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


#: Rows whose words are numbered at a time, so that a worker holds the words of few texts.
ROWS = 2048


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORDS).split()


@dataclass
class Block:
    """The windows of some test items, over numbered terms."""

    size: int
    terms: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], set[int]] = field(default_factory=lambda: defaultdict(set))
    n_words: int = 0

    def add(self, item_id: int, text: str | None) -> None:
        words = words_of(text)
        self.n_words += len(words)
        ids = tuple(self.terms.setdefault(w, len(self.terms)) for w in words)
        for i in range(max(1, len(ids) - self.size + 1) if ids else 0):
            self.windows[ids[i : i + self.size]].add(item_id)

    @property
    def shortest(self) -> int:
        return min(map(len, self.windows), default=self.size)


def blocks(items: DataFrame, size: int, block_words: int) -> Iterator[Block]:
    """The items, read a partition at a time, in blocks of about ``block_words`` words; NULL ids are left out."""
    block = Block(size)
    for r in items.select(F.col("item_id").cast("long"), "text").filter("item_id is not null").toLocalIterator():
        block.add(r[0], r[1])
        if block.n_words >= block_words:
            yield block
            block = Block(size)
    yield block


def dense(known: np.ndarray, wanted: int, span: int) -> np.ndarray:
    """Where a run of ``span`` words, cut at the ends, holds ``wanted`` known ones and this word is one of them."""
    n = len(known)
    if wanted <= 1 or n == 0:
        return known
    sums = np.concatenate([[0], np.cumsum(known)])
    starts = np.arange(1 - span, n)
    full = sums[np.minimum(starts + span, n)] - sums[np.maximum(starts, 0)] >= wanted
    cover = np.concatenate([[0], np.cumsum(full)])
    at = np.arange(n)
    return known & (cover[at + span] - cover[at] > 0)


def postings(docs: DataFrame, block: Block, slop: int, id_col: str, text_col: str) -> DataFrame:
    """The positional index, cut by document: ``doc_id, text_key, n_words, terms, positions``.

    Terms and positions are parallel, sorted by both. Only words that can
    belong to a match are stored: a window of k words lies in some run of
    k + slop words that holds k words of the tests.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.terms)
    shortest = block.shortest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            n_words, terms, positions = [], [], []
            for cell in batch.column(2):
                words = words_of(cell.as_py())
                ids = np.array([get(w, -1) for w in words], np.int32)
                at = np.flatnonzero(dense(ids >= 0, shortest, shortest + slop))
                at = at[np.argsort(ids[at], kind="stable")]
                n_words.append(len(words))
                terms.append(ids[at])
                positions.append(at.astype(np.int32))
            kind = pa.list_(pa.int32())
            arrays = [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(terms, kind), pa.array(positions, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_words", "terms", "positions"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, n_words long, terms array<int>, positions array<int>")


class Searcher:
    """Finds the windows of a block in the postings of some documents."""

    def __init__(self, windows: list[tuple[tuple[int, ...], list[int]]], counts: dict[int, int], slop: int):
        self.slop = slop
        self.longest = max((len(w) for w, _ in windows), default=1)
        self.by_rarest: dict[int, list[tuple]] = defaultdict(list)
        for terms, items in windows:
            order = sorted(range(len(terms)), key=lambda i: (counts.get(terms[i], 0), i))
            if counts.get(terms[order[0]], 0):
                self.by_rarest[terms[order[0]]].append((terms, order, items))

    def search(self, n_words: np.ndarray, term: np.ndarray, place: np.ndarray):
        """Exact and near matches as (start, length, items), places counted over all documents of the batch."""
        order = np.lexsort((place, term))
        term, place = term[order], place[order]
        present, first = np.unique(term, return_index=True)
        ends = np.append(first[1:], len(term))
        lists = {int(t): place[a:b] for t, a, b in zip(present, first, ends)}
        exact, near = [], []
        for rarest in present.tolist():
            for terms, by_count, items in self.by_rarest.get(rarest, ()):
                if any(t not in lists for t in terms):
                    continue
                starts = lists[rarest] - by_count[0]
                for i in by_count[1:]:
                    listed = lists[terms[i]]
                    at = np.searchsorted(listed, starts + i)
                    starts = starts[listed[np.minimum(at, len(listed) - 1)] == starts + i]
                    if not len(starts):
                        break
                if len(starts):
                    exact.append((starts, len(terms), items))
                if self.slop and len(terms) > 1:
                    begun, width = self._near(terms, lists)
                    if len(begun):
                        near.append((begun, width, items))
        return exact, near

    def _near(self, terms, lists):
        """Starts of all words in order within ``slop`` more words than the window has, exact ones left out."""
        begun = now = lists[terms[0]]
        for t in terms[1:]:
            listed = lists[t]
            at = np.searchsorted(listed, now, side="right")
            ok = at < len(listed)
            begun, now = begun[ok], listed[at[ok]]
            ok = now - begun < len(terms) + self.slop
            begun, now = begun[ok], now[ok]
            if not len(begun):
                break
        loose = now - begun >= len(terms)
        return begun[loose], len(terms) + self.slop


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, which overlap or touch, as spans that are parted; memory follows the spans, not the words."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    parted = starts[1:] > reach[:-1]
    return starts[np.append(True, parted)], reach[np.append(parted, True)]


def matches(index: DataFrame, block: Block, slop: int) -> DataFrame:
    """Per index row the hit words as merged spans ``starts, ends``, the ``items`` and the ``near_items``."""
    counts = index.select(F.explode("terms").alias("t")).groupBy("t").count()
    found = {r["t"]: r["count"] for r in counts.collect()}  # at most one row per term of the block
    windows = [(w, sorted(i)) for w, i in block.windows.items()]
    sc = index.sparkSession.sparkContext
    shared = sc.broadcast((windows, found, slop))
    names = ["doc_id", "text_key", "n_words", "starts", "ends", "items", "near_items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value)
        gap = searcher.longest + searcher.slop
        for batch in batches:
            n_words = batch.column(2).to_numpy()
            rows = len(n_words)
            base = np.concatenate([[0], np.cumsum(n_words + gap)]).astype(np.int64)
            terms, places = batch.column(3), batch.column(4)
            sizes = np.diff(terms.offsets.to_numpy())
            own = np.repeat(np.arange(rows), sizes)
            exact, near = searcher.search(n_words, terms.flatten().to_numpy(), places.flatten().to_numpy() + base[own])
            pairs: tuple[set, set] = (set(), set())
            for into, some in zip(pairs, (exact, near)):
                for starts, _, items in some:
                    for row in np.unique(np.searchsorted(base, starts, side="right") - 1).tolist():
                        into.update((row, i) for i in items)
            begin = end = np.zeros(0, np.int64)
            if exact:
                begin, end = merged(np.concatenate([s for s, _, _ in exact]), np.concatenate([s + n for s, n, _ in exact]))
            of = np.searchsorted(base, begin, side="right") - 1
            cols: list[list] = [[[] for _ in range(rows)] for _ in range(4)]
            for row, a, b in zip(of.tolist(), begin.tolist(), end.tolist()):
                cols[0][row].append(a - int(base[row]))
                cols[1][row].append(b - int(base[row]))
            for col, some in zip(cols[2:], pairs):
                for row, item in sorted(some):
                    col[row].append(item)
            kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2)] + [pa.array(c, k) for c, k in zip(cols, kinds)], names=names
            )

    schema = "doc_id long, text_key long, n_words long, starts array<int>, ends array<int>, items array<long>, near_items array<long>"
    return index.mapInArrow(run, schema)


def _positions() -> Column:
    spans = F.filter(F.arrays_zip("starts", "ends"), lambda s: s["ends"] > s["starts"])
    return F.flatten(F.transform(spans, lambda s: F.sequence(s["starts"], s["ends"] - 1)))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    slop: int = 2,
    block_words: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document the words hit by a window of a test item, and the items.

    Returns ``doc_id, text_key, n_words, n_hit, starts, ends, items, near_items``. A window is
    ``window`` consecutive words of an item, or the whole item if it has fewer. Near items have a
    window whose words all occur in order within ``slop`` extra words. Items are taken in blocks of
    ``block_words`` words, which bounds what is broadcast; documents are never shuffled for one block.

    NULL and empty texts have no words and no hits; an empty table gives an empty result, an empty
    list of items no hits. Repeated ids give a row each, and equal rows equal results.
    """
    out = None
    for block in blocks(items, window, block_words):
        index = staged(postings(docs, block, slop, id_col, text_col), "postings")
        found = matches(index, block, slop)
        if out is None:
            out = found
            continue
        more = staged(found, "matches").dropDuplicates(["doc_id", "text_key"])
        more = more.select("doc_id", "text_key", *[F.col(c).alias(f"more_{c}") for c in ("starts", "ends", "items", "near_items")])
        same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
        joined = staged(out, "matches").alias("a").join(more.alias("b"), same, "left")
        out = joined.select(
            F.col("a.doc_id"),
            F.col("a.text_key"),
            "n_words",
            F.concat("starts", F.coalesce("more_starts", F.array().cast("array<int>"))).alias("starts"),
            F.concat("ends", F.coalesce("more_ends", F.array().cast("array<int>"))).alias("ends"),
            F.array_union("items", F.coalesce("more_items", F.array().cast("array<bigint>"))).alias("items"),
            F.array_union("near_items", F.coalesce("more_near_items", F.array().cast("array<bigint>"))).alias("near_items"),
        )
    n_hit = F.size(F.array_distinct(_positions())).cast("long")
    near = F.array_except("near_items", "items")
    return out.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), "starts", "ends", "items", near.alias("near_items"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def without_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no window hits.

    Only the keys of contaminated rows are joined, by id and text hash, so a
    NULL id is told apart by its text.
    """
    bad_id, bad_key = fresh(docs, "_bad_id"), fresh(docs, "_bad_key")
    bad = found.filter("n_hit > 0").select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
