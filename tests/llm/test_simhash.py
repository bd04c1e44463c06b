import random
import re

import numpy as np
import pytest
import xxhash

from llm_cases import *  # noqa: F403
from tillroll.llm import simhash


def brute_fingerprint(text, shingle):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in links:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def brute_labels(marks, radius):
    return labels(len(marks), (
        (i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= radius
    ))


def near_marks(seed, bases=60):
    random.seed(seed)
    marks = set()
    for _ in range(bases):
        base = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 2, 30])):
            x = base
            for _ in range(random.randint(0, 6)):
                x ^= 1 << random.randrange(64)
            marks.add(x)
    return sorted(marks)


@pytest.mark.parametrize("radius", [0, 4, 7])
def test_forest_keeps_every_component(radius):
    marks = near_marks(radius)
    at = {m: k for k, m in enumerate(marks)}
    a, b = simhash.forest(np.zeros(len(marks), dtype=np.int64), np.array(marks, dtype="<u8"), radius)
    found = labels(len(marks), [(at[x], at[y]) for x, y in zip(a.tolist(), b.tolist())])
    assert found == brute_labels(marks, radius)
    assert len(a) < len(marks)  # a forest, not all pairs


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_across_buckets_and_tiles(spark, tile):
    marks = near_marks(9)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    frame = spark.createDataFrame([(m,) for m in signed], "fp long")
    at = {m: k for k, m in enumerate(signed)}
    links = [(at[r["a"]], at[r["b"]]) for r in simhash.links(frame, 4, 6, tile).collect()]
    assert labels(len(marks), links) == brute_labels(marks, 4)


def test_query_matches_brute_force(spark, small_texts):
    rows = sorted(simhash.op1_simhash(spark, SMALL).collect(), key=lambda r: r["doc_id"])
    marks = [brute_fingerprint(small_texts[r["doc_id"]], 4) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{m:016x}" for m in marks]
    assert [r["component_id"] for r in rows] == [rows[k]["doc_id"] for k in brute_labels(marks, 4)]


def test_edges(spark, edge_docs, edge_texts):
    rows = simhash.near_duplicates(edge_docs, shingle=4, radius=4, pieces=6).collect()
    assert len(rows) == len(edge_texts)
    found = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows}
    assert found[1] == found[2] == found[3] == (0, 1)
    assert found[5][1] == found[4][1] == 4 and found[10][1] == 4
    assert found[8] == found[7] and found[7][1] == 7
    assert found[None][1] is None


def test_keep_one_keeps_columns_and_one_of_each_group(edge_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 4, 6, 7, 9]
    assert {r["doc_id"]: r["row"] for r in rows}[6] == "r6"


def test_empty(empty_docs):
    assert simhash.near_duplicates(empty_docs).collect() == []
    assert simhash.keep_one(empty_docs).collect() == []


def long_text(draw, n=300):
    return " ".join(draw.choice("abcdefghij") * 3 + str(draw.randrange(999)) for _ in range(n))


def test_near_copies_and_clean_documents(spark):
    draw = random.Random(2)
    words = [long_text(draw) for _ in range(6)]
    rows = [(k, w) for k, w in enumerate(words)] + [(6, words[0] + " x"), (7, words[1].upper())]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


def test_keep_one_equals_brute_force(spark, small_docs):
    """Kept are the smallest ids of the components that the query reports."""
    found = simhash.op1_simhash(spark, SMALL).collect()
    kept = simhash.keep_one(small_docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in found})
    assert {r["doc_id"]: r for r in kept}.items() <= {r["doc_id"]: r for r in small_docs.collect()}.items()


def test_rows_that_share_an_id(spark):
    draw = random.Random(3)
    a, b, c = (long_text(draw) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "y"), (2, b, "z"), (3, c, "p"), (3, c, "q"), (3, c, "q"), (None, c, "r"),
            (None, "only here", "s"), (None, "only here", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(tuple(r) for r in simhash.keep_one(frame).collect() if r["doc_id"])
    assert kept[:2] == sorted([(1, a, "x"), (1, b, "y")])  # other texts under one id all stay
    assert len(kept) == 3 and kept[2][:2] == (3, c)
    unnamed = [tuple(r) for r in simhash.keep_one(frame).collect() if r["doc_id"] is None]
    assert unnamed == [(None, "only here", "s")]
