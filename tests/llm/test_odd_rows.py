"""Odd rows and extra columns through every operator and pipeline stage."""

import pytest

import corpus_pipeline
from ridgeline.llm import bpe, decontamination, embeddings, linededup, periodic, phrases, pieces, pii, ppm, queries, simhash, toxicity

LONG = "one two three four five six seven eight nine ten eleven twelve\n" * 3000
TEXTS = [(1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "A b C"), (5, "A b C"), (None, "no id here"), (None, "no id here"), (7, "é’ 日本   ½ x1")]
#: Names that operators use inside, as columns of the input.
NAMES = [
    "_gone_id", "_gone_key", "_lines", "_text_key", "_gone", "_bad_id", "_bad_key", "_kept", "row", "parts", "doc", "new", "entity", "kind",
    "doc_id_", "held_out", "score", "predicted", "ids", "n_tokens", "fingerprint", "component_id", "fp", "rep", "node", "root", "runs", "strongest",
    "collapsed", "rank", "n", "word", "kinds", "n_entities", "n_lines", "n_dropped", "path", "leaf", "line", "at", "keep", "text_key", "decodes",
]


def documents(spark, rows=TEXTS):
    cells = [(d, t, "en", "s", len(t or ""), *[1] * len(NAMES)) for d, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` int" for n in NAMES)
    return spark.createDataFrame(cells, schema)


def operators(spark):
    items = spark.createDataFrame([(1, "nine ten eleven twelve one two three four five six", 1)], "item_id long, text string, `_bad_id` int")
    labels = spark.createDataFrame([(4, 0, 1), (5, 1, 1)], "doc_id long, toxic int, score int")
    return {
        "line dedup": lambda d: linededup.deduplicated(d),
        "bpe": lambda d: bpe.encoded(d, queries.VOCABULARY, queries.PATTERN),
        "decontamination": lambda d: decontamination.digest(decontamination.contamination(d, items)),
        "pii": lambda d: pii.replaced(d, "k"),
        "simhash": lambda d: simhash.near_duplicates(d, 4, 4),
        "toxicity": lambda d: toxicity.scored(d, toxicity.fit(d, labels)),
        "ppm": lambda d: ppm.scored(d, order=2),
        "periodic": lambda d: periodic.detected(d),
        "pieces": lambda d: pieces.encoded(d, queries.PIECES),
    }


@pytest.mark.parametrize("name", ["line dedup", "bpe", "decontamination", "pii", "simhash", "toxicity", "ppm", "periodic", "pieces"])
def test_rows_come_back_and_empty_tables_too(spark, name):
    operator = operators(spark)[name]
    got = operator(documents(spark)).collect()
    key = lambda d: (d is None, d or 0)
    assert sorted((r["doc_id"] for r in got), key=key) == sorted((d for d, _ in TEXTS), key=key)
    assert operator(documents(spark).limit(0)).count() == 0


def test_phrases_of_odd_rows(spark):
    assert {r["lang"] for r in phrases.collocations(documents(spark)).collect()} == {"en"}


def test_vectors_with_clashing_names(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 1), (2, [1.0, 0.0], 1, 1), (None, None, 1, 1)], "vec_id long, embedding array<double>, rep int, kept int")
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in embeddings.near_duplicates(df).collect()) == [(0, 0), (1, 1), (2, 1)]


def test_every_stage_of_the_pipeline(spark, data_dir):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data_dir)
        assert out.columns == docs.columns, name
        kept = [r["doc_id"] for r in out.collect()]
        assert kept.count(None) == 2 and {4, 5, 7} <= set(kept), name
        assert stage(spark, docs.limit(0), data_dir).count() == 0
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, data_dir).filter("decodes").count() == len(TEXTS)
