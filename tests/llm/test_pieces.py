"""SentencePiece through the table of marked words against the library on whole texts."""

import hashlib
import random

import pytest
from llm_cases import *  # noqa: F401,F403

from tillroll.llm import pieces


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=pieces.default_vocabulary())


def expected(library, text):
    ids = library.encode(text or "")
    return (
        len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(library.decode(ids).encode()).hexdigest(),
    )


def row(r):
    return r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]


def test_every_document(spark, small_texts, library):
    found = by_id(pieces.op13_sentencepiece(spark, SMALL))
    assert {k: row(r) for k, r in found.items()} == {
        k: expected(library, t) for k, t in small_texts.items()
    }


def test_edges(spark, edge_docs, empty_docs, edge_texts, library):
    found = sorted(map(row, pieces.digest(edge_docs).collect()))
    assert found == sorted(expected(library, t) for _, t in edge_texts)
    assert pieces.digest(empty_docs).count() == 0


def test_random_texts_and_round_trip(spark, library):
    rng = random.Random(5)
    alphabet = ["a", "e", "th", " ", "  ", "▁", "\t", "\n", "\0", "é", "é", "日", "𒀀", " ",
                "<s>", "<unk>", "</s>", "<0x41>", "ﬁ", ".", "12", "ing", "　", "�", ""]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [" " * k for k in range(40)] + ["x" * 70, "ab" * 5000, "é" * 3000 + " " + "日本" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = pieces.encode_documents(docs)
    found = by_id(encoded)
    for k, text in enumerate(texts):
        assert found[k]["ids"] == library.encode(text), text
        assert found[k]["decoded"] == library.decode(library.encode(text)), text
    again = by_id(pieces.decode_documents(encoded))
    assert all(again[k]["decoded"] == found[k]["decoded"] for k in found)


def test_table_is_bounded(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    table = pieces.WordTable(pieces.default_vocabulary())
    for at in range(0, 1000, 10):  # the long word passes through every batch
        words = {f"{pieces.MARK}w{at + k}" for k in range(10)} | {pieces.MARK + "y" * 90}
        known = table.look_up(words)
        assert all(list(known[w][0]) == library.encode(w[1:]) for w in words)
        assert len(table.held) <= 61


def test_crossing_pieces_are_refused(monkeypatch):
    monkeypatch.setattr(pieces, "MARK", "t")  # as if the vocabulary had pieces across its marker
    with pytest.raises(ValueError):
        pieces.WordTable(pieces.default_vocabulary())
