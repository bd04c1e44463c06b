import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from llm_cases import *  # noqa: F403
from tillroll.llm.common import components


@pytest.mark.parametrize("links, expected", [
    ([], {}),
    ([(1, 2), (2, 3), (5, 4)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(k, k + 1) for k in range(40)], {k: 0 for k in range(41)}),
    ([(100, k) for k in range(30)] + [(7, 7)], {**{k: 0 for k in range(30)}, 100: 0}),
])
def test_components(spark, links, expected):
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r["node"]: r["component"] for r in components(frame).collect()} == expected


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        rows = docs.collect()
        seen.append(name)
        if name != "packing":
            assert docs.columns == columns
            after = {r["doc_id"]: r["text"] for r in rows}
            assert set(after) <= set(before) and len(after) == len(rows)
            if name != "pii":
                assert all(before[i] == t for i, t in after.items())
            else:
                assert set(after) == set(before)
                assert not any(re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[a-z]", t) for t in after.values())
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert {r["doc_id"] for r in rows} == set(before)
    assert len(seen) == 5


def test_every_query_is_registered():
    names = {n.split("_")[0] for n in entry.LLM_QUERIES}
    assert names == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


def folder_with(spark, docs, folder):
    """A table folder of these documents with the small benchmark and labels."""
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_chain_on_edge_rows(spark, edge_docs, tmp_path):
    """Null ids and texts, repeated rows and clashing columns pass every stage."""
    folder = folder_with(spark, edge_docs, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == edge_docs.columns, name
        docs = spark.createDataFrame(docs.collect(), edge_docs.schema)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_chain_on_an_empty_table(spark, empty_docs, tmp_path):
    folder = folder_with(spark, empty_docs, tmp_path)
    assert corpus_pipeline.run(spark, folder).collect() == []
