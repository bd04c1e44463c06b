import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from llm_cases import *  # noqa: F403
from tillroll.llm import packing, tokens
from tillroll.llm.tokens import CHUNK, Encoder, default_vocabulary

ODD = [
    "a  b\n\nc \n d\t\te 'll I'm  x's", "", " ", "\n\n", "  a", "a  ", "<|endoftext|> hi", "a<|endoftext|>b",
    "x   <|endoftext|>   y <|endoftext|>", "<|endoftext|><|endoftext|>", "no <|endoftext| here", "a  b c\x1cd\x1f e",
    "x" * 100 + " " + "é" * 50 + "  " + "1234567890" * 10, "日本語 テスト　。", "   x", "it's 'S 's's",
]


def reference():
    t = Tokenizer.from_file(default_vocabulary())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_match_the_tokenizer(small_texts):
    ids, encoder = reference(), Encoder(default_vocabulary())
    texts = ODD + list(small_texts.values())[:80]
    for again in range(2):  # new and remembered chunks
        for text, chunks in zip(texts, encoder.encode_all(texts)):
            assert np.frombuffer(b"".join(chunks), "<u4").tolist() == ids(text)
    assert encoder.encode(ODD[0]) == np.array(ids(ODD[0]), "<u4").tobytes()
    assert all("".join(CHUNK.findall(t)) == t for t in texts)


def test_special_strings_can_be_plain_text():
    encoder = Encoder(default_vocabulary(), plain=True)
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    for text in ODD:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_memory_of_chunks_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    ids, encoder = reference(), Encoder(default_vocabulary())
    for k in range(60):
        texts = [f"word{k} again w{k % 7} other{j}" for j in range(5)]
        for text, chunks in zip(texts, encoder.encode_all(texts)):
            assert np.frombuffer(b"".join(chunks), "<u4").tolist() == ids(text)
        assert len(encoder.seen) <= 60


def test_window_is_filled_as_well_as_possible():
    random.seed(3)
    for _ in range(200):
        counts = {random.randint(1, 20): random.randint(1, 4) for _ in range(4)}
        room = random.randint(0, 60)
        picked = packing.fill_window(counts, room)
        every = itertools.product(*(range(n + 1) for n in counts.values()))
        sums = (sum(k * n for k, n in zip(counts, times)) for times in every)
        assert sum(k * n for k, n in picked.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in picked.items())


def check(rows, texts, capacity):
    ids = reference()
    expected = defaultdict(int)
    for i, t in texts:
        expected[i, tuple(ids(t or "")) + (0,)] += 1
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"], r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for (i, tokens), times in expected.items():
        pieces = sorted(documents[i, len(tokens)], key=lambda p: p[0])
        flat = [x for _, part in pieces[::times] for x in part]
        assert len(pieces) == times * -(-len(tokens) // capacity) and flat == list(tokens)
    return sum(map(sum, ([n for _, n in p] for p in sequences.values()))), len(sequences)


def test_pieces_and_sequences(small_docs, small_texts):
    rows = packing.pack_documents(small_docs).collect()
    total, sequences = check(rows, list(small_texts.items()), 1024)
    assert sequences <= -(-total // 1024) * 1.02


def test_query_carries_checksums(spark, small_texts):
    ids = reference()
    for r in packing.op7_packing(spark, SMALL).collect():
        every = np.array(ids(small_texts[r["doc_id"]]) + [0], dtype="<u4")
        part = every[r["start"]:r["start"] + r["length"]]
        assert (r["ids_crc32"], r["doc_tokens"], r["length"]) == (zlib.crc32(part.tobytes()), len(every), len(part))


def test_edges(edge_docs, edge_texts, empty_docs):
    rows = packing.pack_documents(edge_docs, capacity=256).collect()
    check(rows, edge_texts, 256)
    assert packing.pack_documents(empty_docs).collect() == []


def test_a_third_of_the_rows_share_one_id(spark, small_texts):
    """No bin gets more than its share of them, and null ids spread as well."""
    texts = [(5, small_texts[0])] * 60 + [(None, "no id here")] * 60
    texts += [(1000 + k, "one two three") for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = packing.pack(packing.pieces(docs), 1024, bins=6).collect()
    check(rows, texts, 1024)
    for shared in (5, None):
        bins = [r["sequence_id"] >> 32 for r in rows if r["doc_id"] == shared]
        assert max(bins.count(b) for b in range(6)) < len(bins) / 2 and len(set(bins)) == 6


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), (None, "z"), ("a", "x y")], "doc_id string, text string")
    rows = packing.pack_documents(docs).collect()
    check(rows, [("b", "x y"), (None, "z"), ("a", "x y")], 1024)
