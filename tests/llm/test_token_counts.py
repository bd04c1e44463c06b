import random
import re

import pytest
from tokenizers import Tokenizer

from llm_cases import *  # noqa: F403
from tillroll.llm import token_counts
from tillroll.llm.tokens import CHUNK, Encoder, default_vocabulary

PARTS = ["a", "b ", " ", "  ", "\n", "\n\n", "é", "1", "12 ", "'s", " the", " foo", "\t", "!!", "日本"]


@pytest.fixture(scope="module")
def full():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("leaf", [1, 2, 8])
def test_random_edits_equal_a_full_count(monkeypatch, full, leaf):
    monkeypatch.setattr(token_counts, "LEAF", leaf)
    encoder = Encoder(default_vocabulary(), plain=True)

    def count(chunks):
        return [len(x) // 4 for x in encoder.encode_chunks(chunks)]

    random.seed(leaf)
    for _ in range(150):
        text = "".join(random.choices(PARTS, k=random.randint(0, 60)))
        chunks = CHUNK.findall(text)
        tree = token_counts.TokenTree(chunks, count(chunks), count)
        for _ in range(6):
            a = random.randint(0, len(text))
            b = random.randint(a, min(len(text), a + random.choice([0, 1, 3, 20])))
            new = "".join(random.choices(PARTS, k=random.randint(0, 4)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == full(text)


def test_only_touched_regions_are_encoded_again():
    encoder = Encoder(default_vocabulary(), plain=True)

    def count(chunks):
        return [len(x) // 4 for x in encoder.encode_chunks(chunks)]

    chunks = CHUNK.findall("some plain words " * 5000)
    tree = token_counts.TokenTree(chunks, count(chunks), count)
    tree.edit(40000, 40003, "other")
    assert tree.reencoded < 40


def test_query_matches_a_full_count(spark, small_texts, full):
    rows = by_id(token_counts.op9_token_counts(spark, SMALL))
    for i, text in small_texts.items():
        masked = re.sub(r"[0-9]+|[#*$%&|<>]{2,}", "0", text)
        assert (rows[i]["n_tokens"], rows[i]["n_tokens_after"]) == (full(text), full(masked))
        assert rows[i]["n_chunks"] == len(CHUNK.findall(text))


def test_edges(spark, edge_docs, edge_texts, empty_docs, full):
    kind = "array<struct<start:int,end:int,replacement:string>>"
    none = edge_docs.selectExpr("*", f"CAST(NULL AS {kind}) AS edits")
    rows = token_counts.count(none).collect()
    assert len(rows) == len(edge_texts)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[4] == full(dict(edge_texts)[4])
    frame = spark.createDataFrame(
        [(1, "abc def ghi", [(8, 11, None), (0, 3, "x  "), None]), (2, None, [(0, 0, "new text")])],
        f"doc_id long, text string, edits {kind}",
    )
    found = by_id(token_counts.count(frame))
    assert found[1]["n_tokens_after"] == full("x   def ") and found[1]["n_edits"] == 2
    assert found[2]["n_tokens_after"] == full("new text")
    assert token_counts.count(empty_docs.selectExpr("*", f"CAST(NULL AS {kind}) AS edits")).collect() == []
