import re
from collections import Counter

import numpy as np

from llm_cases import *  # noqa: F403
from tillroll.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(threes)
    repeated = {i + k for i, t in enumerate(threes) if times[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def stats(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_query_matches_brute_force(spark, small_texts):
    rows = by_id(q.op10_quality_rules(spark, SMALL))
    assert set(rows) == set(small_texts)
    for i, text in small_texts.items():
        n, _, _, _, repeated = expected = brute(text)
        assert stats(rows[i]) == expected
        failed = n < 50 or 100 * repeated > 50 * n
        assert rows[i]["base_failed"] == failed and not (failed and rows[i]["kept"])


def test_tricky_texts(spark):
    texts = ["a b c a b c", "a b c d\x0ba b c", "a a a a", "a a a", "x y z x y\nx y z", "l\nl\n \n \nl", "#*$%&|<> é𝒳"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = by_id(q.judge(frame, []))
    assert [stats(rows[i]) for i in range(len(texts))] == [brute(t) for t in texts]


def test_learned_list_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rules = q.learn(docs, labels.where("doc_id % 2 = 0"))
    assert rules
    held = q.judge(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["kept"] for r in held if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in held if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_covering_finds_the_planted_conjunction():
    rng = np.random.default_rng(3)
    x = rng.random((900, len(q.FEATURES)))
    bad = (x[:, 2] > 0.7) & (x[:, 3] <= 0.4)
    grow = np.arange(900) % 3 > 0
    rules = q.cover(x, bad, grow, q.CoverParams())
    assert {c.feature for c in rules[0]} == {q.FEATURES[2], q.FEATURES[3]}
    assert q.cover(x, np.zeros(900, dtype=bool), grow, q.CoverParams()) == []


def test_edges(spark, edge_docs, edge_texts, empty_docs):
    labels = spark.createDataFrame([(None, 0, 0), (1, None, 0), (999, 0, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    rules = q.learn(edge_docs, labels)
    assert rules == []
    rows = q.judge(edge_docs, rules).collect()
    assert len(rows) == len(edge_texts)
    for r in rows:
        if r["doc_id"] is not None:
            assert stats(r) == brute(dict((i, t or "") for i, t in edge_texts)[r["doc_id"]])
    kept = q.keep_good(edge_docs, rules)
    assert kept.columns == edge_docs.columns and kept.collect() == []  # all short, or repeating
    assert q.learn(empty_docs, labels) == [] and q.judge(empty_docs, rules).collect() == []


def test_filter_keeps_whole_rows(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text, "a", "k"), (2, "short", "b", "k"), (1, text, "a", "k")], "doc_id long, text string, row string, kept string")
    assert [tuple(r) for r in q.keep_good(docs, []).collect()] == [(1, text, "a", "k")] * 2
