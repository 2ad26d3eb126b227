"""Phrase collocations: grams counted in HAT-tries, spilled as sorted runs and merged per prefix partition."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import batches_of
from ridgeline.llm.hattrie import FAN, HatTrie
from ridgeline.sources.scratch import staged

#: A-Z to a-z, ends of pieces to line feeds, tabs to blanks; every other byte stays.
SIGNS = bytes(
    c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
#: Bits of a word's number inside a task; three make the key of a container.
ID_BITS = 21
#: Distinct words, and entries of the trie, that a task holds before it spills.
WORDS, ENTRIES = 1 << 20, 1 << 21
#: Words that are counted at a time, and bytes of text that are cut at a time.
BLOCK, CUT = 1 << 19, 1 << 20
#: Entries of a run in one row, and entries that are merged at a time.
RUN, MERGE = 1 << 15, 1 << 19
#: Bits of the map of frequent pairs, as a power of two: 16 MB on every worker, whatever the corpus.
MAP_BITS = 27
LEAST = 10


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def pair_path(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The path of two word hashes; together with the first it tells the second."""
    return mixed(first) + second


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in order, with a line feed between pieces, in lists of bounded length."""
    text = text.translate(SIGNS)
    at = 0
    while at < len(text):
        # A list ends with the word that goes on at its bound.
        ends = [x for x in (text.find(b" ", at + CUT), text.find(b"\n", at + CUT)) if x >= 0]
        end = min(ends) + 1 if ends else len(text)
        yield text[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end


class Vocabulary:
    """Numbers of the words of a task, per language, with their hashes and counts."""

    def __init__(self, seed: int):
        self.seed = seed
        self.of: dict[str, dict[bytes, int]] = {}
        self.hashes = array("Q")
        self.counts = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The number of every word; -1 for a line feed, -2 for nothing."""
        known = self.of.setdefault(lang, {b"\n": -1, b"": -2})
        new = set(words).difference(known)
        salt = lang.encode() + b"\n"
        for word in new:
            known[word] = len(self.hashes)
            self.hashes.append(xxhash.xxh3_64_intdigest(salt + word, self.seed))
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def words_of(self, lang: str, numbers: np.ndarray) -> list[bytes]:
        """The words, or line feeds, of a few numbers."""
        wanted = set(numbers.tolist())
        back = {n: w for w, n in self.of[lang].items() if n in wanted}
        return [back[n] for n in numbers.tolist()]

    def count(self, numbers: np.ndarray) -> None:
        found = np.bincount(numbers[numbers >= 0], minlength=len(self))
        found[: len(self.counts)] += self.counts
        self.counts = found

    def rows(self) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
        """Per language: hashes in order, words, counts."""
        hashes = np.frombuffer(self.hashes, np.uint64)
        for lang, known in self.of.items():
            words = [w for w, n in known.items() if n >= 0]
            numbers = np.array([known[w] for w in words], np.int64)
            by = np.argsort(hashes[numbers]) if len(words) else numbers
            yield lang, hashes[numbers[by]], [words[i] for i in by.tolist()], self.counts[numbers[by]]


RUN_SCHEMA = "part int, kind int, low long, lang string, words binary, keys binary, counts binary"
RUN_ARROW = pa.schema(
    [("part", pa.int32()), ("kind", pa.int32()), ("low", pa.int64()), ("lang", pa.string())]
    + [(n, pa.binary()) for n in ("words", "keys", "counts")]
)


def _as_bytes(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest."""
    return counts.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if counts.max(initial=0) <= np.iinfo(t).max)).tobytes()


def _as_counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def _signed(path: int) -> int:
    """The place of an unsigned number in the order of signed ones."""
    return int(path) - (1 << 63)


def _spans(path: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted paths that belong to one part each and are not too long, with the number of the part."""
    shift = np.uint64(65 - parts.bit_length())
    part = path >> shift if parts > 1 else np.zeros(len(path), np.uint64)
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() + [len(part)]
    for a, b in zip(edges, edges[1:]):
        for lo in range(a, b, RUN):
            yield int(part[a]), slice(lo, min(lo + RUN, b))


def _order(keys: np.ndarray) -> np.ndarray:
    """Positions of the rows of ``keys`` (path, first word, third word) in their order."""
    by = np.argsort(keys[:, 0])
    path = keys[by, 0]
    if (path[1:] == path[:-1]).any():
        by = np.lexsort(keys.T[::-1])
    return by


class Counter:
    """Counts the words and the grams of ``size`` words of one task, with bounded memory."""

    def __init__(self, size: int, parts: int, seed: int, frequent: np.ndarray | None):
        self.size, self.parts, self.seed, self.frequent = size, parts, seed, frequent
        self._begin()

    def _begin(self) -> None:
        self.words = Vocabulary(self.seed)
        self.trie = HatTrie(self._path)

    def _hashes(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.words.hashes, np.uint64)[numbers]

    def _path(self, keys: np.ndarray) -> np.ndarray:
        down = ID_BITS * (self.size - 1)
        mask = (1 << ID_BITS) - 1
        return pair_path(self._hashes(keys >> down), self._hashes(keys >> (down - ID_BITS) & mask))

    def block(self, numbers: np.ndarray, stop: int) -> None:
        """Count the words at the first ``stop`` places and the grams that start there."""
        if self.frequent is None:
            self.words.count(numbers[:stop])
        size = self.size
        if len(numbers) < size:
            return
        ends = len(numbers) - size + 1
        inside = np.ones(min(stop, ends), bool)
        for k in range(size):
            inside &= numbers[k : k + len(inside)] >= 0
        at = np.flatnonzero(inside)
        if self.frequent is not None:
            # A gram that is frequent is made of frequent pairs.
            pairs = np.unique(np.concatenate([at, at + 1]))
            path = pair_path(self._hashes(numbers[pairs]), self._hashes(numbers[pairs + 1]))
            slot = path & np.uint64((1 << MAP_BITS) - 1)
            hit = self.frequent[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)
            may = np.zeros(len(numbers), bool)
            may[pairs] = hit.astype(bool)
            at = at[may[at] & may[at + 1]]
        key = np.zeros(len(at), np.int64)
        for k in range(size):
            key = key << ID_BITS | numbers[at + k]
        if len(key):
            self.trie.add(*np.unique(key, return_counts=True))

    def spilled(self, to: int) -> Iterator[tuple]:
        """Rows of runs of whole subtrees, the largest first, until at most ``to`` entries are left."""
        down = ID_BITS * (self.size - 1)
        mask = (1 << ID_BITS) - 1
        while len(self.trie) > to:
            packed, counts = self.trie.cut(self.trie.largest())
            hashes = [self._hashes(packed >> (down - ID_BITS * k) & mask) for k in range(self.size)]
            keys = np.stack([pair_path(hashes[0], hashes[1]), hashes[0], *hashes[2:]], axis=1)
            by = _order(keys)
            keys, counts = keys[by], counts[by]
            for part, span in _spans(keys[:, 0], self.parts):
                yield part, self.size, _signed(keys[span.start, 0]), None, None, keys[span].tobytes(), _as_bytes(counts[span])

    def finished(self) -> Iterator[tuple]:
        """Rows of all that is held, which is then empty."""
        yield from self.spilled(0)
        if self.frequent is None:
            for lang, hashes, words, counts in self.words.rows():
                for part, span in _spans(hashes, self.parts):
                    yield part, 1, _signed(hashes[span.start]), lang, b" ".join(words[span]), hashes[span].tobytes(), _as_bytes(counts[span])
        self._begin()


def _runs(rows: DataFrame, size: int, parts: int, seed: int, frequent) -> DataFrame:
    """Sorted runs of the grams of ``size`` words (and, without ``frequent``, of the words) of ``lang, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counter(size, parts, seed, None if frequent is None else frequent.value)
        tail = np.array([-1] * size, np.int32)
        held: list[np.ndarray] = []
        n = 0

        def block(last: bool) -> None:
            """Count what is held; unless it is the last block, the words that may begin a gram with the next ones stay."""
            nonlocal held, n
            numbers = np.concatenate(held) if held else np.zeros(0, np.int32)
            stop = len(numbers) if last else max(0, len(numbers) - size + 1)
            c.block(numbers, stop)
            held, n = [numbers[stop:]], len(numbers) - stop

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                raw = (text.as_py() or "").encode()
                name = lang.as_py()
                for words in pieces_of(raw):
                    numbers = c.words.numbers(name, words)
                    held.append(numbers[numbers != -2])
                    n += len(held[-1])
                    if n >= BLOCK:
                        block(last=False)
                        if len(c.trie) > ENTRIES:
                            yield from batches_of(c.spilled(ENTRIES // 2), RUN_ARROW, 32)
                    if len(c.words) > WORDS:
                        block(last=False)
                        kept = c.words.words_of(name, held[0])
                        yield from batches_of(c.finished(), RUN_ARROW, 32)
                        held = [c.words.numbers(name, kept)]
                held.append(tail)
                n += size
        block(last=True)
        yield from batches_of(c.finished(), RUN_ARROW, 32)

    return rows.mapInArrow(run, RUN_SCHEMA)


MERGED_SCHEMA = "kind int, lang string, word binary, path long, first long, second long, third long, n long"
MERGED_ARROW = pa.schema(
    [("kind", pa.int32()), ("lang", pa.string()), ("word", pa.binary())]
    + [(n, pa.int64()) for n in ("path", "first", "second", "third", "n")]
)
#: Kinds of merged rows besides words (1) and grams (2, 3): words of a language in all, and two words with one hash.
TOTAL, CLASH = 0, -1


def _merged_words(rows: list[tuple], least: int) -> Iterator[tuple]:
    """Rows of the words that occur ``least`` times, one total per language, and clashes."""
    counts: dict[int, list] = {}
    totals: dict[str, int] = {}
    for lang, words, keys, raw in rows:
        hashes = np.frombuffer(keys, np.uint64).tolist()
        found = _as_counts(raw, len(hashes))
        totals[lang] = totals.get(lang, 0) + int(found.sum())
        for h, word, n in zip(hashes, words.split(b" "), found.tolist()):
            entry = counts.get(h)
            if entry is None:
                counts[h] = [lang, word, n]
            elif entry[0] == lang and entry[1] == word:
                entry[2] += n
            else:
                yield CLASH, None, None, None, None, None, None, None
    for lang, n in totals.items():
        yield TOTAL, lang, None, None, None, None, None, n
    for h, (lang, word, n) in counts.items():
        if n >= least:
            yield 1, lang, word, None, h - (1 << 64 if h >> 63 else 0), None, None, n


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Every word and gram that occurs ``least`` times, from the runs of all tasks.

    Runs meet by part and come in the order of their first entries, so what lies
    before the last run's first entry is complete and leaves; a part is never
    held whole unless its runs are as many as its entries.
    """

    def grams(kind: int, blocks: list[tuple[np.ndarray, np.ndarray]], before: int | None):
        """Batches of the complete entries, and the rest."""
        keys, counts = (np.concatenate(x) for x in zip(*blocks))
        by = _order(keys)
        keys, counts = keys[by], counts[by]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        done = len(keys) if before is None else int(np.searchsorted(keys[:, 0], np.uint64(before)))
        keep = np.flatnonzero(counts[:done] >= least)
        out = None
        if len(keep):
            path, one = keys[keep, 0], keys[keep, 1]
            two = path - mixed(one)
            none = pa.nulls(len(keep), pa.int64())
            three = pa.array(keys[keep, 2].view(np.int64)) if kind == 3 else none
            cells = [pa.array(np.full(len(keep), kind, np.int32)), pa.nulls(len(keep), pa.string()), pa.nulls(len(keep), pa.binary())]
            cells += [pa.array(x.view(np.int64)) for x in (path, one, two)] + [three, pa.array(counts[keep])]
            out = pa.RecordBatch.from_arrays(cells, schema=MERGED_ARROW)
        return out, [(keys[done:], counts[done:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        now, n = None, 0

        def leave(before: int | None) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            if held and now[1] == 1:
                rows = list(_merged_words(held, least))
                held, n = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MERGED_ARROW)], schema=MERGED_ARROW)
            elif held:
                out, held = grams(now[1], held, before)
                n = len(held[0][0])
                if out is not None:
                    yield out

        for batch in batches:
            for part, kind, low, lang, words, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (part, kind):
                    yield from leave(None)
                    held, now, n = [], (part, kind), 0
                if kind == 1:
                    held.append((lang, words, keys, counts))
                    continue
                matrix = np.frombuffer(keys, np.uint64).reshape(-1, kind)
                held.append((matrix, _as_counts(counts, len(matrix))))
                n += len(matrix)
                if n > MERGE:
                    yield from leave(low + (1 << 63))
                    # What could not leave counts as new, so that merging stays in proportion.
                    n = 0
        yield from leave(None)

    ordered = runs.repartition(F.col("part")).sortWithinPartitions("part", "kind", "low")
    return ordered.mapInArrow(run, MERGED_SCHEMA)


def _frequent_pairs(pairs: DataFrame) -> np.ndarray:
    """A map with the bit of every pair's path set, of MAP_BITS bits whatever the number of pairs."""
    slot = F.col("path").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    word = F.shiftright(slot, 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(path & 63 as int))")
    words = pairs.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def counted(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(words and pairs, triples) that occur ``least`` times, as written tables of MERGED_SCHEMA.

    Words are known by a 64-bit hash of language and word. Two words with one
    hash are noticed where the runs meet, and everything is counted under
    another seed. A second pass counts triples, of those only that consist of two
    frequent pairs by a map of fixed size, which may let others pass.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = max(FAN, 1 << (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())
    for seed in count():
        small = staged(_merged(_runs(rows, 2, parts, seed, None), least), "pairs")
        if small.filter(F.col("kind") == CLASH).isEmpty():
            break
    frequent = spark.sparkContext.broadcast(_frequent_pairs(small.filter("kind = 2")))
    return small, staged(_merged(_runs(rows, 3, parts, seed, frequent), least), "triples")


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    square = F.lit(1_000_000) * a.cast("decimal(15,0)") * a.cast("decimal(15,0)")
    product = l.cast("decimal(18,0)") * r.cast("decimal(18,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), product.cast("decimal(38,0)")).cast("long")


def scored(small: DataFrame, triples: DataFrame, share: int = 50) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every candidate that stays.

    The cut with the lowest score counts, the first among equals. A pair goes
    if a triple that holds it occurs at least ``share`` percent as often.
    """
    words = small.filter("kind = 1").select("lang", "word", F.col("first").alias("hash"), F.col("n").alias("f"))
    totals = small.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    pairs = small.filter("kind = 2").select("first", "second", F.col("n").alias("a"))
    triples = triples.select("first", "second", "third", F.col("n").alias("a"))

    def spelled(df: DataFrame, column: str, place: int) -> DataFrame:
        names = [F.col("hash").alias(column), F.col("word").alias(f"w{place}"), F.col("f").alias(f"f{place}")]
        return df.join(words.select(*names, *([F.col("lang")] if place == 1 else [])), column)

    held = triples.select("first", "second", "a").union(triples.select(F.col("second").alias("first"), F.col("third").alias("second"), "a"))
    held = held.groupBy("first", "second").agg(F.max("a").alias("longer"))
    two = pairs.join(held, ["first", "second"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    two = spelled(spelled(two.drop("longer"), "first", 1), "second", 2)
    two = two.select("lang", F.array("w1", "w2").alias("words"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    three = triples.join(pairs.withColumnRenamed("a", "f12"), ["first", "second"])
    three = three.join(pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("f23")), ["second", "third"])
    three = spelled(spelled(spelled(three, "first", 1), "second", 2), "third", 3)
    three = three.withColumn("s1", _score(F.col("a"), F.col("f1"), F.col("f23"))).withColumn("s2", _score(F.col("a"), F.col("f12"), F.col("f3")))
    one = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang",
        F.array("w1", "w2", "w3").alias("words"),
        "a",
        F.when(one, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(one, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    both = two.union(three).withColumn("phrase", F.array_join(F.transform("words", lambda w: w.cast("string")), " "))
    return both.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, share: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Phrases of two or three words of a piece that occur at least ``least``
    times; ``a`` is how often, ``l`` and ``r`` how often the parts of the
    lowest-scoring cut do, ``n`` all words of the language. Order: score and a
    descending, then phrase by bytes.

    A NULL language is ``und``; NULL and empty texts have no words, and a
    language without a candidate has no row. Repeated rows count each time.
    Other columns are not read; an empty table gives an empty result.
    """
    found = staged(scored(*counted(docs, least, text_col, lang_col), share), "phrases")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's candidates are ranked in salted parts first, so that no task sorts them all.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    close = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return close.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
