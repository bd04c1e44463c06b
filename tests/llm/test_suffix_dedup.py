import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import *  # noqa: F403
from tillroll.llm import suffix_dedup


def brute(texts):
    """doc_id -> (n_bytes, n_removed, n_spans, kept bytes)."""
    seen, out = {}, {}
    for i in sorted(texts):
        t = texts[i]
        mask = bytearray(len(t))
        for p in range(len(t) - 49):
            if seen.setdefault(t[p:p + 50], i) < i:
                mask[p:p + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(t)) if mask[k] and not (k and mask[k - 1]))
        kept = bytes(b for b, m in zip(t, mask) if not m)
        out[i] = (len(t), len(t) - len(kept), spans, kept)
    return out


def same(rows, texts):
    expected = brute(texts)
    assert len(rows) == len(expected)
    for i, (n, gone, spans, kept) in expected.items():
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, gone, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_query_matches_brute_force(spark, small_texts):
    same(by_id(suffix_dedup.op2_suffix_dedup(spark, SMALL)), {i: t.encode() for i, t in small_texts.items()})


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_passages_copies_and_overlaps(spark, block_bytes):
    a = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(400))
    b = "".join(chr(65 + (k * k * 5 + k // 7) % 26) for k in range(300))
    texts = {
        3: a, 1: a[100:149], 2: "x" + a[100:150] + "y", 4: b + a[10:90] + b[:60], 5: b, 6: a,
        7: "z" * 200, 8: "z" * 120, 9: a[:49] + "é" + a[49:], 10: b[20:90] + "é" * 60, 11: "é" * 60,
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = by_id(suffix_dedup.deduplicate(frame, block_bytes=block_bytes))
    encoded = {i: t.encode() for i, t in texts.items()}
    same(found, encoded)
    assert all(bytes(found[i]["kept"]) == kept for i, (_, _, _, kept) in brute(encoded).items())


def test_hot_passage_in_distinct_surroundings_over_many_parts(spark, monkeypatch):
    """One passage in every document, never with the same neighbours, and copies; parts of a few bytes."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 500)
    passage = "".join(chr(97 + (k * k * 11 + k // 5) % 26) for k in range(90))

    def filler(seed, n):
        return "".join(chr(65 + (seed * 7919 + k * k * (seed + 3) + k // 3) % 57) for k in range(n))

    texts = {i: filler(i, 30 + i % 17) + passage + filler(i + 500, 20 + i % 11) for i in range(1, 120)}
    texts |= {200 + i: texts[i] for i in range(1, 40)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = by_id(suffix_dedup.deduplicate(frame, block_bytes=3000))
    encoded = {i: t.encode() for i, t in texts.items()}
    same(found, encoded)
    assert all(bytes(found[i]["kept"]) == kept for i, (_, _, _, kept) in brute(encoded).items())


def test_edges(edge_docs, edge_texts):
    rows = suffix_dedup.deduplicate(edge_docs, with_text=False).collect()
    assert len(rows) == len(edge_texts)
    texts = {i: (t or "").encode() for i, t in edge_texts if i is not None}
    same({r["doc_id"]: r for r in rows if r["doc_id"] is not None}, texts)
    assert [r["n_removed"] for r in rows if r["doc_id"] is None] == [0]


def test_empty(empty_docs):
    assert suffix_dedup.deduplicate(empty_docs).collect() == []


def test_anchors_do_not_depend_on_segments(monkeypatch):
    draw = np.random.default_rng(3)
    lengths = np.array([700, 49, 50, 3000, 0, 51, 1200])
    data = draw.integers(97, 99, lengths.sum()).astype(np.uint8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 20)
    whole = suffix_dedup.Anchors(data, lengths)
    assert len(whole.place) > 100
    for segment in (1, 7, 64, 1000):
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        cut = suffix_dedup.Anchors(data, lengths)
        for name in ("place", "low", "high", "doc", "hash"):
            assert (getattr(whole, name) == getattr(cut, name)).all(), (segment, name)


def test_memory_of_a_block_that_is_repeated_whole():
    """A step over a block takes some tens of bytes for each of its bytes."""
    draw = np.random.default_rng(4)
    text = bytes(draw.integers(97, 123, 2 << 20).astype(np.uint8)).decode()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["x" + text, "y" + text])], ["doc_id", "text"])
    block = next(suffix_dedup._lay_out([batch], 1 << 30)).to_pylist()[0] | {"copies": None}

    def ask(step, by, **more):
        rows = pa.RecordBatch.from_pylist([block | more])
        return by(pa.Table.from_batches(step([rows], parts=1))).to_pylist()

    shared = ask(suffix_dedup._tell_anchors, suffix_dedup._find_shared)
    covered = ask(suffix_dedup._tell_contexts, suffix_dedup._order_contexts, answers=shared)
    rows = pa.RecordBatch.from_pylist([block | {"shared": shared, "covered": covered}])
    tracemalloc.start()
    found = next(suffix_dedup._remove([rows], parts=1, with_text=False)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["n_removed"], r["n_spans"]) for r in found] == [(0, 0), (len(text), 1)]
    assert peak < 40 * 2 * len(text)
