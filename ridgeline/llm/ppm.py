"""Language-model scores by partial matching over bytes, beside a unigram score over words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import LOWER, crc_bucket
from ridgeline.sources.scratch import staged

#: Ends a text and fills the context before it; UTF-8 never has this byte.
END = 0xFF
#: Positions that are worked on at a time.
PIECE = 1 << 18
#: Distinct grams, or words, that a task counts before they leave it.
HELD = 1 << 20
#: Rows that are scored at a time, so that a worker holds little beside the probabilities.
ROWS = 512
SYMBOLS = 256
#: What each listed symbol gives to the escape of its context.
DISCOUNT = 0.5


class Lookup:
    """An open-addressing table from distinct non-negative int64 keys to their positions."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 1.5))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.at = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            took, which = np.unique(slot[free], return_index=True)
            rows = left[free][which]
            self.keys[took], self.at[took] = keys[rows], rows
            waiting = np.ones(len(left), bool)
            waiting[np.flatnonzero(free)[which]] = False
            left, slot = left[waiting], (slot[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of ``keys``, -1 where there is none."""
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.at[slot], -1)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            seen, want = self.keys[slot], keys[left]
            hit = seen == want
            out[left[hit]] = self.at[slot[hit]]
            on = ~hit & (seen != -1)
            left, slot = left[on], slot[on]
        return out


def _positions(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams (``order`` bytes and a symbol) of the texts with their END, and the number of the text of each."""
    joint = bytes([END]) * (order + 1)
    held: list[bytes] = []
    first = size = 0
    for n, text in enumerate(texts + [None]):
        if text is not None:
            held.append(text)
            size += len(text) + order + 1
            if size < PIECE:
                continue
        if not held:
            return
        raw = np.frombuffer(joint[:order] + joint.join(held) + joint[:1], np.uint8)
        lengths = np.array([len(t) + 1 for t in held])
        of = np.repeat(np.arange(first, first + len(held)), lengths)
        starts = np.repeat(np.cumsum(lengths + order) - lengths, lengths)
        at = starts + np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        for lo in range(0, len(at), PIECE):
            place = at[lo : lo + PIECE]
            # Of every byte of the stretch, in order; the few between two texts are left out at the end.
            begin, end = int(place[0]), int(place[-1]) + 1
            gram = raw[begin - order : end - order].astype(np.int64)
            for back in range(order - 1, -1, -1):
                gram <<= 8
                gram |= raw[begin - back : end - back]
            yield gram[place - begin], of[lo : lo + PIECE]
        first, size, held = n + 1, 0, []


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    """The lower-cased texts of a batch as bytes."""
    return [(t.as_py() or "").encode().translate(LOWER) for t in batch.column(column)]


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """``gram, n`` over all of ``texts`` (one string column), added up on the map side first."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        gram = np.concatenate([g for g, _ in held])
        by = np.argsort(gram)
        gram, n = gram[by], np.concatenate([c for _, c in held])[by]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        return gram[first], np.add.reduceat(n, first)

    def emitted(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        gram, n = merged(held)
        for lo in range(0, len(gram), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(gram[part]), pa.array(n[part])], names=["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Over all batches of a task, so that a gram leaves it about once.
        held: list[tuple[np.ndarray, np.ndarray]] = []
        new = 0
        for batch in batches:
            for gram, _ in _positions(_texts(batch, 0), order):
                held.append(np.unique(gram, return_counts=True))
                new += len(held[-1][0])
                if new > HELD // 2:
                    held, new = [merged(held)], 0
                    if len(held[0][0]) > HELD:
                        yield from emitted(held)
                        held = []
        if held:
            yield from emitted(held)

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def contexts_of(grams: DataFrame, order: int, least: int) -> list[DataFrame]:
    """``context, total, next`` for contexts of 0 to ``order`` bytes: all that follows one, and its symbols with their counts.

    Symbols that follow a context fewer than ``least`` times are part of its
    total only; a context without a symbol is left out.
    """
    tables: list[DataFrame] = []
    level = grams
    for k in range(order, -1, -1):
        symbol = F.struct(F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("s"), "n")
        context = level.groupBy(F.shiftright("gram", 8).alias("context"))
        table = context.agg(F.sum("n").alias("total"), F.collect_list(F.when(F.col("n") >= least, symbol)).alias("next"))
        tables.insert(0, staged(table.filter(F.size("next") > 0), "contexts"))
        if k:
            low = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
            level = staged(level.groupBy(low.alias("gram")).agg(F.sum("n").alias("n")), "grams")
    return tables


def log_probabilities(wanted: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``gram, log`` for distinct ``gram``: log10 of the probability of the last byte after the bytes before it.

    From the longest context down, a gram is joined to its context. The escape
    of a context gets what follows it but is not listed, and half an occurrence
    of every listed symbol. On an escape the symbols of the longer context are
    excluded below. Grams that are found leave, so shorter contexts see few.
    Contexts of at most one byte are 257 at most and are broadcast.
    """
    left = wanted.select("gram", F.lit(0.0).alias("log"), F.array().cast("array<int>").alias("gone"))
    done = None

    def mass(symbols: Column) -> Column:
        return F.aggregate(symbols, F.lit(0.0), lambda sum_, x: sum_ + x["n"] - DISCOUNT)

    for k in range(len(tables) - 1, -1, -1):
        context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * k) - 1))
        joined = left.withColumn("context", context).join(F.broadcast(tables[k]) if k < 2 else tables[k], "context", "left")
        symbol = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
        escape = F.col("total") - mass(F.col("next"))
        room = mass(F.filter("next", lambda x: ~F.array_contains("gone", x["s"]))) + escape
        paid = F.get(F.filter("next", lambda x: x["s"] == symbol), F.lit(0))["n"] - DISCOUNT
        step = joined.select(
            "gram",
            (F.col("log") + F.coalesce(F.log10(F.coalesce(paid, escape) / room), F.lit(0.0))).alias("log"),
            F.when(paid.isNotNull(), F.array().cast("array<int>")).otherwise(F.coalesce(F.transform("next", lambda x: x["s"]), "gone")).alias("gone"),
            paid.isNotNull().alias("found"),
        )
        step = staged(step, "probabilities")
        found = step.filter("found").select("gram", "log")
        done = found if done is None else done.union(found)
        left = step.filter("not found").drop("found")
        if left.isEmpty():
            return done
    unseen = F.log10(F.greatest(F.lit(1), SYMBOLS - F.size("gone")))
    return done.union(left.select("gram", (F.col("log") - unseen).alias("log")))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all of ``texts`` (one string column)."""

    def emitted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch, 0):
                counts.update(text.split())
                if len(counts) > HELD // 4:
                    yield emitted(counts)
                    counts.clear()
        yield emitted(counts)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def scored(
    docs: DataFrame,
    order: int = 5,
    share: int | None = None,
    common: int = 1 << 16,
    frequent: int = 1 << 22,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Rows whose crc32 of the id, modulo 7, is 2 are held out; all others train
    both models, whole texts. ``score`` is the log10 probability of the
    lower-cased bytes and the end of the text after contexts of at most
    ``order`` bytes; ``base_score`` that of the words and one end under add-one
    word counts. Every gram of the corpus is in the model, unless ``share`` is
    given: then only those that make up 1 / ``share`` of all positions are.

    The probabilities of grams that make up 1 / ``frequent`` of all positions
    and the counts of words that make up 1 / ``common`` of all tokens go to
    every worker (at most ``frequent`` and ``common`` of them); those of all
    other grams and words are joined, to the same result.

    NULL and empty texts have one token, the end. A NULL id is not held out;
    repeated ids give a row each. Without a training row every probability is
    that of an empty model: one in 256 a byte, and 1 / 1 a word.
    """
    if order > 5:
        raise ValueError("a gram of more than six bytes and a row's number do not fit into one key")
    spark = docs.sparkSession
    held = F.coalesce(crc_bucket(id_col, 7) == 2, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = rows.filter("not held_out").select("text")
    grams = staged(gram_counts(train, order), "grams")
    positions = grams.agg(F.sum("n")).first()[0] or 0
    tables = contexts_of(grams, order, -(-positions // share) if share else 1)
    held_grams = log_probabilities(grams.filter(F.col("n") * frequent >= positions).select("gram"), tables).toArrow()
    lookup, gram_logs = Lookup(held_grams.column("gram").to_numpy()), held_grams.column("log").to_numpy()
    words = staged(word_counts(train), "words")
    n_docs = train.count()
    n_words, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n = n_words + n_docs
    room = n + kinds + (1 if n_docs else 0) + 1
    often = words.filter(F.col("c") * common >= n).toArrow()
    counts = dict(zip(often.column("word").to_pylist(), often.column("c").to_pylist()))
    shared = spark.sparkContext.broadcast((lookup, gram_logs, counts))
    end = float(np.log10(n_docs + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, log_of, known = shared.value
        logs = {w: float(np.log10(c + 1)) for w, c in known.items()}
        for batch in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            texts = _texts(batch, 2)
            score = np.zeros(len(texts))
            rare = []
            bits = 8 * (order + 1)
            for gram, of in _positions(texts, order):
                at = inside.find(gram)
                there = at >= 0
                score += np.bincount(of[there], weights=log_of[at[there]], minlength=len(texts))
                # Both fit into one key, which sorts faster than two.
                rare.append(np.unique(of[~there] << bits | gram[~there], return_counts=True))
            of_gram, times = (np.concatenate(x) for x in zip(*rare)) if rare else (np.zeros(0, np.int64),) * 2
            of, gram = of_gram >> bits, of_gram & ((1 << bits) - 1)
            cuts = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32())
            n_tokens, n_known, base, rare_words, rare_n = [], [], [], [], []
            for text in texts:
                words_ = text.split()
                found = list(map(logs.get, words_))
                rest = Counter(w for w, x in zip(words_, found) if x is None) if None in found else {}
                n_tokens.append(len(words_) + 1)
                n_known.append(len(words_) - sum(rest.values()) + (n_docs > 0))
                base.append(sum(x for x in found if x is not None) + end)
                rare_words.append(list(rest))
                rare_n.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(score)]
                + [pa.array(rare_words, pa.list_(pa.binary())), pa.array(rare_n, pa.list_(pa.int64()))]
                + [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int64())) for x in (gram, times)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "words", "times", "grams", "grams_n"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
    schema += ", words array<binary>, times array<long>, grams array<long>, grams_n array<long>"
    first = staged(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = first.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), "w.times")
    log = F.log10(F.col("c") + 1) * F.col("times")
    of_words = rare.join(words, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(log).alias("logs"))
    rare = first.select("row", F.explode(F.arrays_zip("grams", "grams_n")).alias("g")).select("row", F.col("g.grams").alias("gram"), "g.grams_n")
    # A training row has no gram that is not counted; held-out rows may.
    unseen = first.filter("held_out").select(F.explode("grams").alias("gram")).distinct().join(grams, "gram", "left_anti")
    wanted = grams.filter(F.col("n") * frequent < positions).select("gram").union(unseen)
    log = staged(log_probabilities(wanted, tables), "logs")
    of_grams = rare.join(log, "gram").groupBy("row").agg(F.sum(F.col("log") * F.col("grams_n")).alias("rest"))
    base = F.col("base") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(room)))
    joined = first.drop("words", "times", "grams", "grams_n").join(of_words, "row", "left").join(of_grams, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )
