import duckdb
import pytest

from llm_cases import *  # noqa: F403
from tillroll.llm import decontaminate


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, size string")


def words(n, salt=""):
    return " ".join(f"w{salt}{k}" for k in range(n))


def found(spark, docs, benchmark):
    frame = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), items(spark, benchmark)
    )
    return {(r["doc_id"], r["item_id"]): r for r in frame.collect()}


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, folder):
    frame = decontaminate.op8_decontaminate(spark, folder)
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = duck.execute(decontaminate.OP8_SQL)
    assert frame.columns == [d[0] for d in result.description]
    expected = sorted(result.fetchall())
    assert sorted(map(tuple, frame.collect())) == expected and expected


def test_exact_near_and_clean(spark):
    item = words(60)
    near = item.split()
    near[30] = "other"
    far = item.split()
    far[10] = far[30] = far[50] = "other"
    docs = [
        (1, words(100, "x") + "  " + item.upper() + "\n" + words(50, "y")), (2, words(7, "z") + " " + " ".join(near)),
        (3, " ".join(far)), (4, words(200, "q")), (5, item), (6, " ".join(item.split()[:30])),
        (7, item + " " + item), (8, "w0 w1 w2 w3"),
    ]
    rows = found(spark, docs, [(1, item, 5, "s"), (2, item, None, None), (3, "w0 w1 w2 w3", 1, "s"), (4, None, 1, "s")])
    assert set(rows) == {(d, i) for d in (1, 2, 5, 7) for i in (1, 2)}
    assert rows[1, 1]["start_word"] == 100 and rows[1, 1]["similarity"] == 1.0
    assert rows[2, 1]["start_word"] == 7 and rows[2, 1]["similarity"] == pytest.approx(51 / 61)
    assert rows[7, 2]["start_word"] == 0


def test_weights_and_short_documents(spark):
    item = " ".join(["a b c d e"] * 8)  # shingles that repeat inside the item
    rows = found(spark, [(1, item), (2, " ".join(["a b c d e"] * 3)), (3, " ".join(["a b c d e"] * 7 + ["a b c"]))],
                 [(1, item, 0, "")])
    assert set(rows) == {(1, 1), (3, 1)}


def test_edges(spark, edge_docs, empty_docs):
    benchmark = items(spark, [(1, "one two three", 7, "a"), (None, words(9), 1, "a"), (2, words(9), 1, "a")])
    kept = decontaminate.drop_contaminated(edge_docs, benchmark)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert decontaminate.contaminated(empty_docs, benchmark).collect() == []
    assert decontaminate.contaminated(edge_docs, benchmark.limit(0)).collect() == []


def test_filter_drops_repeated_rows_of_a_leak(spark):
    docs = spark.createDataFrame([(1, words(30)), (1, words(30)), (2, words(30, "k"))], "doc_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items(spark, [(1, words(30), 1, "")]))
    assert [r["doc_id"] for r in kept.collect()] == [2]
