"""A corpus from raw documents to token ids, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import bpe, decontamination, linededup, simhash, toxicity
from ridgeline.llm.common import fresh, table
from ridgeline.llm.queries import PATTERN, SIMHASH, VOCABULARY
from ridgeline.sources.scratch import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored one half or more go. The classifier learns from the labelled documents of ``sf_dir``."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs stay in the document with the smallest id only.

    ``n_chars`` follows the text where it changes. A document that loses all
    its lines goes; empty documents as they came, and NULLs, stay.
    """
    kept = linededup.deduplicated(docs)
    lines, gone = kept.columns[-2:]
    kept = kept.filter((F.col(gone) == 0) | (F.col(gone) < F.col(lines)))
    out = kept.select(*docs.columns, F.col(gone).alias(fresh(docs, "_gone")))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, length).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; repeated rows once, NULL ids all."""
    groups = simhash.near_duplicates(docs, **SIMHASH)
    kept = fresh(docs, "_kept")
    first = groups.filter("doc_id = component_id").select(F.col("doc_id").alias(kept)).distinct()
    named = docs.filter("doc_id is not null")
    one = named.join(first, F.col("doc_id").cast("long") == F.col(kept), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.without_contaminated(docs, found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, their digest, and the digest of the decoded bytes."""
    return bpe.encoded(docs, VOCABULARY, PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", encode),
]

#: Compression lengths and merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
