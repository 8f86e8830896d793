import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm.piece_bpe import PieceCodec, encode_pieces

sentencepiece = pytest.importorskip("sentencepiece")
vocabularies = pytest.importorskip("public_tokenizers")
MODEL = vocabularies.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\t", "\n", "▁", "é", "😀", "\x00", "�", "中", "文", "<s>", "<0x41>", "1", "22", "　", "     ", "the", "ing"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_whole_texts_against_the_library(library):
    draw = random.Random(3)
    texts = ["".join(draw.choices(PARTS, k=draw.randrange(40))) for _ in range(2000)]
    texts += ["", " ", "a ", " " * 5000, "ab" * 3000, "中" * 2000, "e" * 5001, " " * 50]
    coder = PieceCodec(MODEL)
    for _ in range(2):  # the second time from remembered parts
        ids = [np.frombuffer(p, "<i4").tolist() for p in coder.encode_all(texts)]
        assert ids == library.encode(texts)
    assert [coder.decode(i) for i in ids] == library.decode(ids)


def test_decoding_of_any_ids(library):
    draw, coder = random.Random(5), PieceCodec(MODEL)
    byte = library.piece_to_id("<0x00>")
    some = [0, 1, 2, 264, 259, 28705, 300, 1318, *(byte + b for b in (0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 0xFF))]
    for _ in range(5000):
        ids = draw.choices(some, k=draw.randrange(8))
        assert coder.decode(ids) == library.decode(ids), ids


def test_a_text_as_one_part(library):
    coder = PieceCodec(MODEL)
    coder.cut = lambda text: [text]
    texts = ["one two  three", " x ", "the same the same the same"]
    assert [np.frombuffer(p, "<i4").tolist() for p in coder.encode_all(texts)] == library.encode(texts)


def test_a_difference_ends_the_job():
    coder = PieceCodec(MODEL)
    coder.pieces = {p: x for p, x in coder.pieces.items() if p != "▁the"}
    with pytest.raises(ValueError, match="other ids for '▁the'"):
        coder.encode_all(["the"])


def test_few_remembered_parts(library, monkeypatch):
    monkeypatch.setattr("fareflow.llm.piece_bpe.CACHED_PARTS", 3)
    coder = PieceCodec(MODEL)
    for text in ["a b c", "c d e f g", "a b " + "long" * 50, "", "a b c"]:
        assert np.frombuffer(coder.encode_all([text])[0], "<i4").tolist() == library.encode(text)
    assert len(coder.known) <= 5


def test_rows(spark, library):
    data = [(1, "Some text.", "x", 1), (2, None, "x", 1), (2, "", "x", 1), (None, "tie", "x", 1), (3, "tie", "x", 1),
            (3, "tie", "x", 1), (4, "long word " * 30_000, "x", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, IDS string, decoded int")
    found = encode_pieces(docs, MODEL)
    assert found.columns == ["doc_id", "ids", "decoded"]
    expected = [(d, library.encode(t or ""), t or "") for d, t, *_ in data]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert encode_pieces(docs.limit(0), MODEL).count() == 0
    hashed = found.select(F.array_join(F.col("ids").cast("array<string>"), ",").alias("x")).where("x = ''").count()
    assert hashed == 2
