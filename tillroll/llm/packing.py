"""Packing: documents cut into pieces and packed into sequences by minimum bin slack.

A document's ids end with id 0. It is cut into pieces of ``capacity`` ids, which fill a sequence
each, and one remainder. Remainders are packed window by window: the longest one left opens the
window, and a subset-sum table over the counts of the remaining lengths, one bit per reachable
fill, picks the multiset that fills it closest to its capacity; walking the table back gives how
many of each length. The same multiset is used again as long as the counts last.

Pieces are dealt into bins of about ``bin_docs`` documents by the hash of their id, their start and
their number in the task that made them, so rows that share an id, or have none, spread like any
others; every bin packs itself, so no task sees more than one bin at a time and the padding of a
bin's last windows is shared by thousands of documents. Ids need no shuffle unless the caller carries
them along.

Defined results: a null text counts as empty and gives the one id 0. The tokenizer's special strings
in a text give their ids, as the library has it by default. Repeated rows are documents of their own. Ties between pieces of one length go by id, then start. Extra columns are left alone.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import id_and_text
from tillroll.llm.tokens import default_vocabulary, encoder

CAPACITY = 1024
BIN_DOCS = 2000
END = bytes(4)  # id 0 closes a document
TOGETHER = 1 << 20  # characters of text that are encoded together


def fill_window(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum is closest below ``room``."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, lot = min(counts[length], room // length), 1
        while left:
            lot = min(lot, left)  # lots of 1, 2, 4, ... make every count up to the number left
            steps.append((length, lot, reach))
            reach |= reach << (length * lot) & full
            left -= lot
            lot *= 2
        if reach >> room & 1:
            break
    at, picked = reach.bit_length() - 1, {}
    for length, lot, before in reversed(steps):
        if not before >> at & 1:
            at -= length * lot
            picked[length] = picked.get(length, 0) + lot
    return picked


def windows(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(multiset, times) until no length is left."""
    counts, out = dict(counts), []
    while counts:
        longest = max(counts)
        rest = {k: n - (k == longest) for k, n in counts.items() if n > (k == longest)}
        chosen = fill_window(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in chosen.items())
        out.append((chosen, times))
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, number): ids as little-endian unsigned 32-bit numbers.

    ``number`` counts the pieces of a task.
    """
    texts = id_and_text(docs, id_column, text_column)
    path = vocabulary or default_vocabulary()

    def run(batches):
        encode_all, number = encoder(path).encode_all, 0
        for batch in batches:
            ids_column, text_column = batch.column(0), batch.column(1)
            at = 0
            while at < len(ids_column):
                some, held = [], 0
                while at < len(ids_column) and held < TOGETHER:
                    some.append(text_column[at].as_py())
                    held += len(some[-1])
                    at += 1
                rows = []
                owners = ids_column.slice(at - len(some), len(some)).to_pylist()
                for doc_id, chunks in zip(owners, encode_all(some)):
                    ids = b"".join(chunks) + END
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        part = ids[4 * start:4 * (start + capacity)]
                        rows.append((doc_id, start, len(part) // 4, part, n, number))
                        number += 1
                yield _batch(rows, ids_column.type)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, number long"
    )


def _batch(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "number"]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _pack_bin(key, frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    frame = frame.sort_values(["length", "doc_id", "start", "number"], kind="stable", ignore_index=True)
    length = frame["length"].to_numpy()
    sequence, offset = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int64)
    lengths, first, count = np.unique(length, return_index=True, return_counts=True)
    following = {int(k): int(at) for k, at in zip(lengths, first)}
    number = 0
    for chosen, times in windows({int(k): int(n) for k, n in zip(lengths, count)}, capacity):
        of = number + np.arange(times)
        at = 0
        for k in sorted(chosen, reverse=True):
            for _ in range(chosen[k]):
                rows = following[k] + np.arange(times)
                sequence[rows], offset[rows] = of, at
                following[k] += times
                at += k
        number += times
    frame["sequence_id"] = (int(key[0]) << 32) + sequence
    frame["offset"] = offset
    return frame.drop(columns=["bin", "number"])


def pack(parts: DataFrame, capacity: int = CAPACITY, bins: int = 1) -> DataFrame:
    """``parts(doc_id, start, length, number, ...)`` with ``sequence_id`` and ``offset`` for ``number``."""
    dealt = F.pmod(F.xxhash64("doc_id", "start", "number"), F.lit(bins)).cast("long")
    binned = parts.withColumn("bin", dealt)
    kinds = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema if f.name != "number"
    )
    return binned.groupBy("bin").applyInPandas(
        partial(_pack_bin, capacity=capacity), f"{kinds}, sequence_id long, offset long"
    )


def bins_for(docs: DataFrame, bin_docs: int = BIN_DOCS) -> int:
    return max(1, -(-docs.count() // bin_docs))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """The packed pieces with their ids: what a training run reads."""
    return pack(pieces(docs, capacity, vocabulary), capacity, bins_for(docs))


def digest(docs: DataFrame) -> DataFrame:
    """The packed pieces with a checksum in place of the ids, which then stay out of the shuffle."""
    parts = pieces(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "number",
    )
    return pack(parts, CAPACITY, bins_for(docs))


def op7_packing(spark, sf_dir):
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
