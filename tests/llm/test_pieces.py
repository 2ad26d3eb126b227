"""SentencePiece encoding against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from ridgeline.llm import pieces, queries

SIGNS = [" ", "  ", "▁", "a", "the", "é", "日", "½", "\n", "\t", "\r", "\x00", "　", "🙂", "<s>", "<0x0A>", "int", "é", "\xa0"]
ODD = [None, "", " ", "▁", "a" * 3000, " " * 777 + "x", "one two three\n" * 3000, "A b C", "A b C", "é’ 日本   ½ x1", "<unk>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def docs_of(spark, texts):
    rows = [(n if n % 7 else None, t, 1, "x") for n, t in enumerate(texts, start=1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")


@pytest.mark.parametrize("small", [False, True])
def test_any_text_as_the_library(spark, library, monkeypatch, small):
    if small:  # parts of texts, tables that start anew, the heap for nearly all chunks
        monkeypatch.setattr(pieces, "CHUNKS", 40)
        monkeypatch.setattr(pieces, "REMEMBERED", 10)
        monkeypatch.setattr(pieces, "SHORT", 3)
        monkeypatch.setattr(pieces, "SIDE_BY_SIDE", 50)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(400)]
    codec = pieces.Codec(queries.PIECES)
    parts = [[] for _ in texts]
    for row, ids in codec.encode(texts):
        parts[row].extend(ids.tolist())
    assert parts == [library.encode(t or "") for t in texts]
    got = pieces.encoded(docs_of(spark, texts), queries.PIECES, with_ids=True).collect()
    want = sorted(expected(library, t) for t in texts)
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(len(r["ids"]) == r["n_tokens"] and (r["ids"][0], r["ids"][-1]) == (1, 2) for r in got)


def test_query_as_the_library(spark, data_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    got = queries.op13_sentencepiece(spark, data_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {d: expected(library, t) for d, t in texts.items()}


def test_empty_table_and_other_models(spark, tmp_path):
    assert pieces.encoded(docs_of(spark, ["x"]).limit(0), queries.PIECES).count() == 0
    made = sentencepiece.sentencepiece_model_pb2.ModelProto()
    with open(queries.PIECES, "rb") as f:
        made.ParseFromString(f.read())
    made.pieces[500].piece = "a▁b"
    path = tmp_path / "crossing.model"
    path.write_bytes(made.SerializeToString())
    with pytest.raises(ValueError, match="cross a mark"):
        pieces.Codec(str(path))
