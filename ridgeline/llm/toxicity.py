"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import crc_bucket

#: Bytes that separate words: everything ASCII but letters, digits and the apostrophe; A-Z become a-z.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c == 39 else 32 for c in range(256)
)
#: Windows a worker remembers the distance of.
REMEMBERED = 1 << 18


@dataclass(frozen=True)
class Settings:
    """Parameters. The bounds on labelled rows are the only samples taken; dictionaries have a size in bytes."""

    toxic_rows: int = 4_000
    ordinary_rows: int = 12_000
    toxic_bytes: int = 8_192
    ordinary_bytes: int = 32_768
    level: int = 15
    repeats: int = 4
    significance: float = 10.0
    lift: float = 4.0
    thresholds: tuple[int, ...] = (2, 3, 4, 5, 6)


def coder(content: bytes, level: int):
    """The compress function under a dictionary; a window's frame carries nothing but its blocks."""
    bare = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(**bare).compress
    shared = zstandard.ZstdCompressionDict(content)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=shared, **bare).compress


@dataclass
class Model:
    """Two dictionaries and the calibration of what their distances say about a text."""

    toxic: bytes
    ordinary: bytes
    settings: Settings
    weights: list[float] = field(default_factory=list)
    known: dict = field(default_factory=dict, repr=False)
    coders: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "coders": None}

    def distance(self, word: bytes) -> int:
        """By how many bytes the toxic dictionary shortens a window more than the ordinary one.

        A window is one word, repeated so that the compressor finds it worth
        coding; the repeats cost the same under either dictionary.
        """
        if self.coders is None:
            self.coders = tuple(coder(d, self.settings.level) for d in (self.ordinary, self.toxic))
        window = (b" " + word) * self.settings.repeats + b" "
        plain, toxic = self.coders
        return len(plain(window)) - len(toxic(window))

    def features(self, text: str | None) -> list[float]:
        """Per threshold the damped share of windows at or above it, and whether there is one."""
        words = (text or "").encode().translate(WORDS).split()
        counts = [0] * len(self.settings.thresholds)
        if words:
            known = self.known
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.distance(w)
            far = np.fromiter(map(known.__getitem__, words), np.int16, len(words))
            counts = [int((far >= t).sum()) for t in self.settings.thresholds]
        size = len(words) + 20
        return [100 * c / size for c in counts] + [math.log1p(c) for c in counts]

    def score(self, text: str | None) -> float:
        x = self.weights[0] + sum(w * f for w, f in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def trained(windows: list[tuple[bytes, int]], size: int, level: int, repeats: int) -> bytes:
    """A dictionary over windows with their counts.

    The trainer gives next to nothing when it is asked for more than there is
    to choose from, so the size is halved until the dictionary fills half of
    it. Of a few segment lengths the one counts whose dictionary codes the
    windows shortest. Too few windows for the trainer are themselves the
    dictionary.
    """
    # Damped counts: the trainer looks for segments that many samples have.
    samples = [b" " + w + b" " for w, n in windows for _ in range(math.isqrt(n))]
    made = [b"".join(b" " + w for w, _ in windows)[-size:]] if windows else [b""]
    for k, d in ((24, 8), (16, 6), (8, 6)):
        wanted = size
        while wanted >= 256:
            try:
                content = zstandard.train_dictionary(wanted, samples, k=k, d=d, level=level).as_bytes()
            except zstandard.ZstdError:
                content = b""
            if 2 * len(content) >= wanted:
                made.append(content)
                break
            wanted //= 2

    def cost(content: bytes) -> int:
        code = coder(content, level)
        return sum(n * len(code((b" " + w) * repeats + b" ")) for w, n in windows)

    return min(made[1:] or made, key=cost)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Weights of a ridge-penalised logistic regression by Newton's method; the first is the intercept."""
    scale = x.std(axis=0) + 1e-9
    a = np.hstack([np.ones((len(x), 1)), x / scale])
    w = np.zeros(a.shape[1])
    keep = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + keep, a.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return [float(w[0]), *(w[1:] / scale).tolist()]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``toxic, word, docs``: in how many texts of the batch a word occurs, by label."""
    for batch in batches:
        counts: dict[tuple[int, bytes], int] = {}
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for w in set((text.as_py() or "").encode().translate(WORDS).split()):
                counts[toxic, w] = counts.get((toxic, w), 0) + 1
        rows = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.int32()), pa.array([w for _, w in rows], pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["toxic", "word", "docs"],
        )


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from labelled rows outside the held-out fold (crc32 of the id modulo 5 equal 0).

    At most ``toxic_rows`` and ``ordinary_rows`` labelled rows are used, the
    first by a hash of the id. Folds 1 to 3 give word counts by label, from
    which the windows for the dictionaries come: all words of ordinary text, and
    for toxic text those whose document rate exceeds the ordinary rate
    significantly and ``lift`` times. Fold 4 calibrates the thresholds, and the
    odds are corrected from the sample's share of toxic rows to that of all
    labelled rows. Whole texts are read, on the executors; the driver gets the
    words and the features of the bounded rows.
    """
    use = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    use = use.withColumn("fold", crc_bucket("doc_id", 5).cast("int")).filter("fold != 0").withColumn("order", F.xxhash64("doc_id"))
    bounds = {1: settings.toxic_rows, 0: settings.ordinary_rows}
    chosen = [r for c, n in bounds.items() for r in use.filter(F.col("toxic") == c).orderBy("order", "doc_id").limit(n).collect()]
    spark = docs.sparkSession
    schema = "doc_id long, toxic int, fold int"
    sample = spark.createDataFrame([(r["doc_id"], r["toxic"], r["fold"]) for r in chosen], schema)
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    learn = joined.filter("fold < 4").select("toxic", "text").mapInArrow(_words, "toxic int, word binary, docs long")
    of = {c: F.sum(F.when(F.col("toxic") == c, F.col("docs")).otherwise(0)) for c in (0, 1)}
    counts = learn.groupBy("word").agg(of[0].alias("plain"), of[1].alias("toxic"))
    n = {c: sum(1 for r in chosen if r["toxic"] == c and r["fold"] < 4) for c in (0, 1)}
    # Words of a bounded sample of texts, all of them.
    top = counts.filter("plain > 0").orderBy(F.desc("plain"), "word").collect()
    rate = (F.col("plain") + 1) / (n[0] + 2)
    lift = (F.col("toxic") / max(1, n[1]) - rate) / F.sqrt(rate * (1 - rate) / max(1, n[1]))
    often = F.col("toxic") / max(1, n[1]) >= settings.lift * rate
    marked = counts.filter((F.col("toxic") >= 2) & (lift >= settings.significance) & often)
    marked = marked.orderBy(F.desc("toxic"), "word").collect()
    model = Model(
        trained([(bytes(r["word"]), r["toxic"]) for r in marked], settings.toxic_bytes, settings.level, settings.repeats),
        trained([(bytes(r["word"]), r["plain"]) for r in top], settings.ordinary_bytes, settings.level, settings.repeats),
        settings,
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = joined.filter("fold = 4").select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").collect()
    rows = sorted((r["toxic"], r["x"]) for r in rows)
    y = np.array([t for t, _ in rows], float)
    width = 2 * len(settings.thresholds)
    if 0 < y.sum() < len(y):
        model.weights = logistic(np.array([x for _, x in rows]), y)
        # The sample has its own share of toxic rows; odds are those of all labelled rows of the fold.
        of_fold = {r["toxic"]: r["n"] for r in use.filter("fold = 4").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        taken = {c: sum(1 for r in chosen if r["toxic"] == c and r["fold"] == 4) for c in (0, 1)}
        model.weights[0] += math.log(of_fold[1] * taken[0] / (of_fold[0] * taken[1]))
    else:
        rate = (n[1] + 1) / (n[0] + n[1] + 2) if n[0] or n[1] else 0.0
        model.weights = [math.log(rate / (1 - rate)) if 0 < rate < 1 else -5.0] + [0.0] * width
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; only the text decides the score.

    NULL and empty texts have no window and get the score of a text without
    any sign of toxicity. Repeated or NULL ids are scored row by row (a NULL
    id is not held out); an empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = known.value
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    ids = F.col(id_col).cast("long").alias("doc_id")
    out = docs.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under one half; nothing is shuffled."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = known.value
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t.as_py()) < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
