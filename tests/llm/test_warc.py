import hashlib

import duckdb
import pyarrow.fs as pafs
import pytest

from llm_cases import *  # noqa: F403
from tillroll.llm import warc

LONG = "<p>" + "same words " * 20 + "</p>"
PAGES = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (1, "http://a/1\r\nX-Evil: 1", "short"),
    (2, "http://a/2", "short"), (4, "http://a/4", None), (None, "http://a/n", "x" * 200), (6, "u", "é" * 50),
    (7, "u", "é" * 50), (8, "u", "WARC/1.1\r\n\r\n" * 30), (8, "u", "WARC/1.1\r\n\r\n" * 30), (10, "u", "b" * 300000),
]


def expected(pages):
    first = {}
    for i, h in sorted((i, h) for i, h in pages if i is not None):
        if len(h) >= 100:
            first.setdefault(h, i)
    out = []
    for i, h in pages:
        own = first.get(h, i)
        revisit = own != i and h in first
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if revisit else "response", own if revisit else None))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert sorted(map(tuple, warc.op5_warc(spark, SMALL).collect()), key=str) == expected(pages)


def test_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(
        [(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, payload string, first int"
    )
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    rows = sorted(map(tuple, warc.op5_warc(spark, str(tmp_path)).collect()), key=str)
    assert rows == expected([(i, (h or "").encode()) for i, _, h in PAGES])
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(duck.execute(warc.OP5_SQL).fetchall(), key=str) == rows
    warc.write_archive(frame, f"{tmp_path}/archive")
    back = warc.read_archive(spark, f"{tmp_path}/archive").collect()
    stored = {r["page_id"]: bytes(r["payload"]) for r in back if r["record_type"] == "response"}
    html = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(stored[i] == html[i] for i in stored)
    urls = {r["page_id"]: r["url"] for r in back}
    assert urls[9] is None and urls[1] == "http://a/1%0D%0AX-Evil: 1"
    only = warc.read_archive(spark, f"{tmp_path}/archive", payload=False).where("page_id = 3 AND record_type = 'response'")
    assert [(r["payload"], r["payload_bytes"]) for r in only.collect()] == [(None, len(LONG))]


def test_headers_decide_before_payloads_are_read(tmp_path, monkeypatch):
    rows = [
        {"record_type": "response", "page_id": k, "refers_to": None, "url": "u", "payload": bytes([65 + k]) * 500,
         "payload_digest": str(k)} for k in range(5)
    ]
    path = f"{tmp_path}/a.warc"
    with open(path, "wb") as f:
        f.write(b"".join(warc.record(r, "2020-01-01T00:00:00Z") for r in rows))
    decoded = []
    plain = warc._payload
    monkeypatch.setattr(warc, "_payload", lambda block: decoded.append(1) or plain(block))
    found = list(warc.read_records(path, [("page_id", frozenset([3]))], payload=True))
    assert [r["payload"] for r in found] == [b"D" * 500] and len(decoded) == 1
    assert len(list(warc.read_records(path, [], payload=False))) == 5 and len(decoded) == 1


def test_broken_archive_is_refused(tmp_path):
    path = f"{tmp_path}/b.warc"
    with open(path, "wb") as f:
        f.write(b"no archive\r\n")
    with pytest.raises(ValueError):
        list(warc.read_records(path, [], payload=True))


def test_aborted_write_leaves_no_archive(tmp_path):
    writer = warc.WarcWriter(str(tmp_path / "x"), "d", 100)
    import pyarrow as pa

    row = {"record_type": "response", "page_id": 1, "refers_to": None, "url": "u", "payload": b"p" * 300, "payload_digest": "0"}
    message = writer.write([pa.RecordBatch.from_pylist([row, row])])
    assert len(message.files) == 2  # rolled
    writer.abort([message, None])
    assert pafs.LocalFileSystem().get_file_info(pafs.FileSelector(str(tmp_path / "x"))) == []


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op5_warc(spark, str(tmp_path)).collect() == []
