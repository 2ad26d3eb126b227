"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import bpe, decontamination, embeddings, htmltext, langid, linededup, periodic, phrases, pieces, pii, ppm, simhash, toxicity
from ridgeline.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Whoever runs the library on real data passes a secret of their own.
SURROGATE_KEY = "registered query"
#: Words of a shingle, and the most bits by which two linked fingerprints differ.
SIMHASH = {"shingle": 4, "max_bits": 4}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.detected(table(spark, sf_dir, "documents"), periodic.looped))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), PIECES)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bpe": op2_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_language": op4_language,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_html": op7_html,
    "op8_embeddings": op8_embeddings,
    "op9_toxicity": op9_toxicity,
    "op10_ppm": op10_ppm,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_sentencepiece": op13_sentencepiece,
}
ORACLE: dict[str, str] = {}
