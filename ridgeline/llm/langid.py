"""Language of web pages: text, declared language, address and host, fused by Bayes' rule."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.htmltext import main_text
from ridgeline.sources.scratch import staged

DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.I)
HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", re.I)


@dataclass(frozen=True)
class Settings:
    """``rows`` labelled texts per language train the text model, the first by a hash of the id.

    Byte trigrams overlap, so their evidence counts ``temper`` times; ``host`` and ``suffix`` are the
    pages' worth of evidence by which a host leans on its suffix and a suffix on all pages,
    ``declared`` the one by which a language's declarations lean on all declarations.
    """

    rows: int = 2_000
    buckets: int = 1 << 15
    temper: float = 0.3
    host: float = 5.0
    suffix: float = 20.0
    declared: float = 5.0


def trigrams(text: str | None, buckets: int) -> np.ndarray:
    """Hash buckets of the byte trigrams of the lower-cased text, blanks as one space."""
    raw = np.frombuffer((" " + " ".join((text or "").lower().split()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(8)).astype(np.int64) % buckets


@dataclass
class TextModel:
    languages: list[str]
    log: np.ndarray  # language x bucket

    def likelihood(self, text: str | None, temper: float) -> np.ndarray:
        at = trigrams(text, self.log.shape[1])
        return temper * self.log[:, at].sum(axis=1)


def fit(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Smoothed trigram probabilities of every language found, from a bounded sample of its labelled texts, counted on the executors."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    ids = known.select(F.col(id_col).cast("long").alias("sample_id"), F.lower(lang_col).alias("lang")).withColumn("o", F.xxhash64("sample_id"))
    ids = ids.withColumn("slot", F.shiftright("o", 52))
    # The slots of the hash that hold a language's first rows are counted out first, so that no task sorts a whole language.
    before = Window.partitionBy("lang").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = ids.groupBy("lang", "slot").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    last = staged(slots.filter(F.col("before") < s.rows).groupBy("lang").agg(F.max("slot").alias("last")), "slots")
    early = ids.join(F.broadcast(last), "lang").filter("slot <= last")
    ranked = early.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("o", "sample_id")))
    chosen = staged(ranked.filter(F.col("n") <= s.rows).select("sample_id", "lang"), "sample")
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    codes = docs.sparkSession.createDataFrame(list(zip(languages, range(len(languages)))), "lang string, code int")
    chosen = chosen.distinct().join(F.broadcast(codes), "lang").select("sample_id", "code")
    texts = known.join(chosen, F.col(id_col).cast("long") == F.col("sample_id")).select("code", F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), s.buckets), np.int64)
        for batch in batches:
            for code, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[code] += np.bincount(trigrams(text.as_py(), s.buckets), minlength=s.buckets)
        code, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(code, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[code, bucket])], names=["code", "bucket", "n"]
        )

    summed = texts.mapInArrow(run, "code int, bucket int, n long").groupBy("code", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(languages), s.buckets), 0.5)
    code, bucket, n = (summed.column(c).to_numpy() for c in ("code", "bucket", "n"))
    np.add.at(counts, (code, bucket), n)
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def evidence(pages: DataFrame, model: TextModel, s: Settings, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, host, suffix, declared, likelihood, p``: what each page says by itself; ``p`` is text alone."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            hosts, suffixes, declared, likelihoods, ps = [], [], [], [], []
            for url, page in zip(batch.column(1), batch.column(2)):
                address, source = url.as_py() or "", page.as_py() or ""
                host = (HOST.match(address) or [None, ""])[1].lower().rstrip(".")
                hosts.append(host)
                suffixes.append(host.rpartition(".")[2])
                found = DECLARED.search(source[: source.lower().find("<body")] if "<body" in source.lower() else source)
                declared.append(found[1].lower() if found else "")
                like = m.likelihood(main_text(source), s.temper)
                likelihoods.append(like)
                p = np.exp(like - like.max()) if len(like) else like
                ps.append(p / p.sum() if len(p) else p)
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hosts), pa.array(suffixes), pa.array(declared), pa.array(likelihoods, doubles), pa.array(ps, doubles)],
                names=["page_id", "url", "host", "suffix", "declared", "likelihood", "p"],
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, host string, suffix string, declared string, likelihood array<double>, p array<double>")


def identified(
    pages: DataFrame, model: TextModel, s: Settings = Settings(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, lang, confidence, declared, host`` for every row of ``pages``.

    The posterior is text likelihood x P(declared | language) x P(language | host). The last leans
    on the host's suffix and that on all pages, a page's own share left out, so a host with many
    pages decides for itself and one with a single page inherits. All three are sums of the text's
    posteriors by group, added up before they are shuffled; a hot host is one sum per task.

    NULL and empty pages and addresses have no text, declaration or host ('' counts as a value of
    its own) and get the prior that is left; a model without languages gives NULL. Repeated or NULL
    ids give a row each; an empty table an empty result. Ties go to the first language by name.
    """
    n = len(model.languages)
    seen = staged(evidence(pages, model, s, id_col, url_col, html_col), "evidence")
    if not n:
        return seen.select("page_id", "url", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), "declared", "host")

    def sums(name: str) -> list[Column]:
        return [F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(n)]).alias(name)]

    hosts = staged(seen.groupBy("suffix", "host").agg(*sums("host_n")), "hosts")
    by_suffix = hosts.groupBy("suffix").agg(F.array(*[F.sum(F.get("host_n", F.lit(i))) for i in range(n)]).alias("suffix_n"))
    total = by_suffix.agg(*[F.sum(F.get("suffix_n", F.lit(i))) for i in range(n)]).first()
    everywhere = F.array(*[F.lit(float(x or 0)) for x in total])
    hosts = staged(hosts.join(staged(by_suffix, "suffixes"), "suffix"), "hosts").select("host", "host_n", "suffix_n")
    said = staged(seen.groupBy("declared").agg(*sums("said_n")), "declared")
    pages_n = float(sum(x or 0 for x in total)) or 1.0

    def size(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def less(a: Column) -> Column:
        return F.zip_with(a, F.col("p"), lambda x, y: F.greatest(x - y, F.lit(0.0)))

    def lean(counts: Column, on: Column, weight: float) -> Column:
        all_ = size(counts) + weight
        return F.zip_with(counts, on, lambda x, y: (x + weight * y) / all_)

    rows = seen.join(hosts, "host").join(said, "declared")
    base = less(everywhere)
    rows = rows.withColumn("prior", F.transform(base, lambda x: (x + 1.0) / (size(base) + n)))
    rows = rows.withColumn("prior", lean(less(F.col("suffix_n")), F.col("prior"), s.suffix))
    rows = rows.withColumn("prior", lean(less(F.col("host_n")), F.col("prior"), s.host))
    share = size(F.col("said_n")) / pages_n
    rows = rows.withColumn("said", F.zip_with(less(F.col("said_n")), less(everywhere), lambda x, y: (x + s.declared * share) / (y + s.declared)))
    logs = F.zip_with("likelihood", F.zip_with("prior", "said", lambda x, y: F.log(x) + F.log(y)), lambda x, y: x + y)
    rows = rows.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    confidence = 1 / size(F.transform("logs", lambda x: F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(c) for c in model.languages])
    lang = F.get(names, F.array_position("logs", F.col("top")).cast("int") - 1)
    return rows.select("page_id", "url", lang.alias("lang"), confidence.alias("confidence"), "declared", "host")
