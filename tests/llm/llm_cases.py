"""Fixtures and helpers of these tests; each module imports them all."""

import pytest

__all__ = ["SMALL", "by_id", "edge_docs", "edge_texts", "empty_docs", "small_docs", "small_texts"]

SMALL = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet consectetur 12 " * 3000
# Names that an operator might use inside; values differ, so mixing them up shows.
CLASHING = "row string, words string, fp long, kept string, stats string, bin long, block long, " \
    "edits_ string, spans string, component_id long, size long, h long, part long"


def extra(k):
    return (f"r{k}", f"w{k}", k, f"k{k}", f"s{k}", k, k, "e", "s", k, k, k, k)


@pytest.fixture(scope="session")
def edge_texts():
    """(doc_id, text): null, empty, blank, very long, tied, repeated and short texts."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (5, LONG), (6, "one"),
        (7, "one two three"), (8, "one two three"), (9, "Ünïcödé 日本語 𝒳 text mail a.b@c.de"),
        (None, "no id here at all, just a text"), (10, LONG + " and a tail"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    rows = [
        (i, t, None if k % 2 else "en", None, None, *extra(k)) for k, (i, t) in enumerate(edge_texts)
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    )


@pytest.fixture(scope="session")
def empty_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_texts(small_docs):
    return {r["doc_id"]: r["text"] or "" for r in small_docs.collect()}


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}
