"""WARC archives as a Python data source: written record by record, read headers first.

Writing: each task rolls its own files under temporary names; the driver renames them once all tasks
have succeeded, so a lost executor leaves no half-written archive. Payloads are stored compressed
behind plain headers, so a reader can jump over one without decoding it.

Reading: one partition per file. Predicates on record type and header columns are pushed into the
reader, which parses a record's headers, tests them, and only then reads and decodes the payload, if
it is wanted at all (option ``payload``: ``true`` or ``false``).

Defined results: a null html counts as empty; a null page id or url is left out of the headers and
comes back null; line breaks in a url are percent-encoded. Rows that share an id and a payload are
all responses. An empty table gives an empty archive. Extra columns are left alone.
"""

from __future__ import annotations

import io
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
    WriterCommitMessage,
)

from tillroll.llm.common import scratch_path

ROLL_BYTES = 64 << 20
LEAST_SHARED = 100  # smaller payloads are always stored, fixed by the contract
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_type string, record_id string, page_id long, refers_to long, url string, date string,"
    " payload_digest string, payload_bytes long, payload binary"
)
PUSHED = ("record_type", "record_id", "page_id", "refers_to", "url", "date", "payload_digest")


def _file_system(path: str):
    return pafs.FileSystem.from_uri(path)


def _record_id(page_id) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"


def record(row: dict, date: str) -> bytes:
    """One WARC record with its trailing blank lines."""
    payload, kind = row["payload"], row["record_type"]
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    body = b""
    if kind == "response":
        body = zlib.compress(payload, 6)
        head.append("Content-Encoding: deflate")
        head.append(f"Content-Length: {len(body)}")
    block = "\r\n".join(head).encode() + b"\r\n\r\n" + body
    fields = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(row['page_id'])}",
        f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if row["page_id"] is not None:
        fields.append(f"X-Page-ID: {row['page_id']}")
    if row["url"] is not None:
        fields.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        fields.append(f"WARC-Profile: {PROFILE}")
        fields.append(f"WARC-Refers-To: {_record_id(row['refers_to'])}")
        if row["refers_to"] is not None:
            fields.append(f"X-Refers-To-Page-ID: {row['refers_to']}")
    fields.append(f"Content-Length: {len(block)}")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(stream) -> dict | None:
    """Header fields of the next record in lower case, or None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record starts with {line[:40]!r}")
    fields = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _row(fields: dict) -> dict:
    return {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "page_id": _number(fields.get("x-page-id")),
        "refers_to": _number(fields.get("x-refers-to-page-id")),
        "url": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "payload_digest": (fields.get("warc-payload-digest") or "").rpartition(":")[2] or None,
        "payload_bytes": _number(fields.get("x-payload-length")),
        "payload": None,
    }


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return zlib.decompress(body) if b"\r\ncontent-encoding: deflate" in head.lower() else body


def read_records(path: str, tests: list[tuple[str, frozenset]], payload: bool):
    """Rows of one file whose header values pass every (column, allowed values) test."""
    system, place = _file_system(path)
    with io.BufferedReader(system.open_input_file(place), 1 << 20) as stream:
        while (fields := _headers(stream)) is not None:
            length = int(fields.get("content-length", 0))
            row = _row(fields)
            if any(row[c] is None or row[c] not in allowed for c, allowed in tests):
                stream.seek(length, io.SEEK_CUR)
                continue
            if payload and row["record_type"] == "response":
                row["payload"] = _payload(stream.read(length))
            else:
                stream.seek(length, io.SEEK_CUR)
            yield row


class WarcFile(InputPartition):
    pass


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in PUSHED and isinstance(f, EqualTo):
                self.tests.append((column, frozenset([f.value])))
            elif column in PUSHED and isinstance(f, In):
                self.tests.append((column, frozenset(f.value)))
            else:
                yield f

    def partitions(self):
        system, place = _file_system(self.path)
        found = system.get_file_info(pafs.FileSelector(place, allow_not_found=True))
        scheme = self.path[: -len(place)] if self.path.endswith(place) else ""
        return [WarcFile(scheme + f.path) for f in found if f.path.endswith(".warc")] or [WarcFile("")]

    def read(self, partition):
        schema = pa.schema([
            (n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
            for n, t in (c.split() for c in SCHEMA.split(", "))
        ])
        rows, held = [], 0
        for row in read_records(partition.value, self.tests, self.payload) if partition.value else ():
            rows.append(row)
            held += len(row["payload"] or b"") + 200
            if held > 1 << 23:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str, roll: int):
        self.path, self.date, self.roll = path.rstrip("/"), date, roll

    def write(self, iterator):
        system, place = _file_system(self.path)
        system.create_dir(place, recursive=True)
        files, stream, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if stream is None or size > self.roll:
                    if stream is not None:
                        stream.close()
                    files.append(f"{place}/{uuid.uuid4().hex}.open")
                    stream, size = system.open_output_stream(files[-1]), 0
                data = record(row, self.date)
                stream.write(data)
                size += len(data)
        if stream is not None:
            stream.close()
        return Written(files)

    def commit(self, messages):
        system, _ = _file_system(self.path)
        for message in messages:
            for name in message.files if message else ():
                system.move(name, name.removesuffix(".open") + ".warc")

    def abort(self, messages):
        system, _ = _file_system(self.path)
        for message in messages:
            for name in message.files if message else ():
                system.delete_file(name)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``frame.write.format("warc").mode("append")``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite):
        date = self.options.get("date", "1970-01-01T00:00:00Z")
        return WarcWriter(self.options["path"], date, int(self.options.get("roll", ROLL_BYTES)))


def to_records(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Rows to write: equal payloads of ``least`` bytes or more are stored once, by the smallest id."""
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        body.alias("payload"), F.sha2(body, 256).alias("payload_digest"),
    )
    shared = rows.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("payload_digest", "first", F.lit(True).alias("repeated"))
    again = F.col("repeated") & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "payload_digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), "page_id",
        F.when(again, F.col("first")).alias("refers_to"), "url", "payload", "payload_digest",
    )


def write_archive(pages: DataFrame, path: str) -> None:
    pages.sparkSession.dataSource.register(WarcSource)
    to_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark, path: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op5_warc(spark, sf_dir):
    """Responses are read with their payloads, which are measured anew; revisits by their headers."""
    path = scratch_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    stored = read_archive(spark, path).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to",
    )
    again = read_archive(spark, path, payload=False).where("record_type = 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    return stored.union(again)


OP5_SQL = """
WITH bodies AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS size FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM bodies
), typed AS (
  SELECT *, size >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM firsts
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM typed
"""
