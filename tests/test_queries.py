"""Registered queries against their SQL oracles on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_sql import ORACLES

QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}
NAMES = sorted(ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("customer", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    picked = [tuple(r[i] for i in at) for r in rows]
    return order, sorted(picked, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    found = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck.execute(ORACLES[name])
    expected = comparable([d[0] for d in result.description], result.fetchall())
    assert found == expected


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert all(n.startswith(("clv_", "high_risk_customers")) for n in without)


def test_entry_returns_the_segment_profile(spark):
    rows = entry.entry(spark).collect()
    assert [r["rfm_segment"] for r in rows] == ["Champions", "Loyal", "At Risk", "Lost"]
    assert [r["n"] for r in rows] == [32, 41, 31, 46]
