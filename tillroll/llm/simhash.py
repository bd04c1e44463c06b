"""SimHash near-duplicates: fingerprints, a bit-sliced comparison, components.

A fingerprint has a bit for each of 64 places, set where more than half of the hashes of the text's
word shingles have it. Two fingerprints within ``radius`` differing bits leave at least
``pieces - radius`` of the ``pieces`` parts of the 64 bits untouched, so each fingerprint is filed
under every choice of that many parts and meets all its links in one of the buckets. Inside a bucket
the comparison is bit-sliced: bit planes lie across 64 fingerprints per machine word, distances of a
whole word of them are kept in vertical counters fed by a carry-save adder, and a word is abandoned
once all its 64 distances exceed the radius.

Scale: equal fingerprints become one before anything is compared. A bucket that holds more than
``tile`` fingerprints is dealt into tiles, each pair of tiles its own unit of work. A task returns
a spanning forest of the links it found, never all pairs. More pieces make more, smaller buckets:
choose ``pieces`` so that ``64 * (pieces - radius) / pieces`` bits spread the fingerprints.

Defined results: a null text counts as empty; no words give fingerprint zero, which links like any
other; fewer words than a shingle give one shingle of all of them. A null id gets a fingerprint and
the component of its text (null if no other id is in it). Repeated rows get equal results. Extra
columns are left alone. ``keep_one`` keeps one row of each component: the smallest id, null ids last,
then the least hash of the text; rows that share an id but not a component all stay, and of rows equal
in id and text the one with the least hash of the whole row.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import components, id_and_text, written

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
SEED = 42


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """A 64-bit hash of every word shingle of one text, in order."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    n = max(1, len(words) - shingle + 1)
    parts = zip(*(words[k:n + k] for k in range(min(shingle, len(words)))))
    return np.fromiter(
        (xxh64_intdigest(x, SEED) for x in map(b" ".join, parts)), dtype="<u8", count=n
    )


def fingerprint(text: str, shingle: int) -> int:
    """The fingerprint of one text, unsigned."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, h, fp) with a hash of the text and the fingerprint as signed 64-bit numbers."""
    texts = id_and_text(docs, id_column, text_column).select("doc_id", F.xxhash64("text").alias("h"), "text")

    def run(batches):
        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(marks.view("<i8"))], ["doc_id", "h", "fp"]
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, h long, fp long")


def _planes(marks: np.ndarray) -> np.ndarray:
    """(64, words): plane b holds bit b of 64 fingerprints per word."""
    padded = np.zeros(-(-len(marks) // 64) * 64, dtype="<u8")
    padded[: len(marks)] = marks
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _exceeding(counters: list, radius: int) -> np.ndarray:
    """Lanes whose vertical counter is above ``radius``."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above |= equal & counters[k]
            equal = equal & ~counters[k]
    return above


def close_lanes(planes, marks, probe, word, live, radius: int):
    """(probe, lane) of all lanes of ``word`` within ``radius`` of their probe, among ``live`` ones.

    Entry k compares fingerprint ``marks[probe[k]]`` with the 64 lanes of plane word ``word[k]``.
    """
    depth = max(1, radius.bit_length())
    own, over = marks[probe], ~live
    counters = [np.zeros(len(probe), dtype=np.uint64) for _ in range(depth)]
    for b in range(0, 64, 2):
        one = planes[b][word] ^ (np.uint64(0) - (own >> np.uint64(b) & np.uint64(1)))
        two = planes[b + 1][word] ^ (np.uint64(0) - (own >> np.uint64(b + 1) & np.uint64(1)))
        half = counters[0] ^ one
        carry = (counters[0] & one) | (half & two)  # of the three-to-two adder
        counters[0] = half ^ two
        for k in range(1, depth):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 6:
            over |= _exceeding(counters, radius)
            kept = np.flatnonzero(over != ALL)
            if len(kept) < 0.75 * len(over):
                probe, word, own, over = probe[kept], word[kept], own[kept], over[kept]
                counters = [c[kept] for c in counters]
                if not len(kept):
                    break
    over |= _exceeding(counters, radius)
    hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(hits)
    return probe[at], word[at] * 64 + lane


def _join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Give both ends of each link, and all that shares their labels, the smaller label."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
    return label


def forest(group: np.ndarray, marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of a spanning forest of the links inside each run of equal ``group``."""
    n = len(marks)
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.array([], dtype=int)
    sizes = np.diff(np.r_[cuts, n])
    kept = np.repeat(sizes > 1, sizes)
    group, marks = group[kept], marks[kept]
    n = len(marks)
    if not n:
        return marks, marks
    sizes = sizes[sizes > 1]
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    which = np.repeat(np.arange(len(sizes)), sizes)
    end = (begin + sizes)[which]
    lane = np.arange(n)
    first = (lane + 1) >> 6
    count = np.where(lane + 1 < end, ((end - 1) >> 6) - first + 1, 0)
    planes, label = _planes(marks), np.arange(n)
    step = np.cumsum(count)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(step, (step[at - 1] if at else 0) + (1 << 15), "right")))
        probes = lane[at:stop]
        # A bucket that is one component already has nothing left to find.
        whole = np.minimum.reduceat(label, begin) == np.maximum.reduceat(label, begin)
        probes = probes[~whole[which[probes]]]
        at = stop
        times = count[probes]
        probe = np.repeat(probes, times)
        if not len(probe):
            continue
        word = first[probe] + (np.arange(len(probe)) - np.repeat(np.cumsum(times) - times, times))
        low = np.maximum(probe + 1 - 64 * word, 0).astype(np.uint64)
        high = np.minimum(end[probe] - 64 * word, 64).astype(np.uint64)
        live = (ALL << low) & (ALL >> (np.uint64(64) - high))
        label = _join_labels(label, *close_lanes(planes, marks, probe, word, live, radius))
    moved = np.flatnonzero(label != lane)
    return marks[moved], marks[label[moved]]


def _linked(batches, radius: int):
    """Forest edges of the sorted (bucket, fp) rows of one partition, a few thousand rows at a time."""
    waiting: list = []

    def edges(rows):
        bucket = np.concatenate([b for b, _ in rows])
        marks = np.concatenate([m for _, m in rows]).view("<u8")
        a, b = forest(bucket, marks, radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view("<i8")), pa.array(b.view("<i8"))], ["a", "b"]
        )

    held = 0
    for batch in batches:
        bucket = batch.column(0).to_numpy(zero_copy_only=False)
        marks = np.ascontiguousarray(batch.column(1).to_numpy(zero_copy_only=False))
        if not len(bucket):
            continue
        waiting.append((bucket, marks))
        held += len(bucket)
        if held < 1 << 15:
            continue
        bucket = np.concatenate([b for b, _ in waiting])
        marks = np.concatenate([m for _, m in waiting])
        cut = int(np.searchsorted(bucket, bucket[-1], "left"))  # the last bucket may go on
        if cut:
            yield edges([(bucket[:cut], marks[:cut])])
        waiting, held = [(bucket[cut:], marks[cut:])], len(bucket) - cut
    if waiting:
        yield edges(waiting)


def links(marks: DataFrame, radius: int, pieces: int, tile: int = 2048) -> DataFrame:
    """(a, b) edges between the distinct fingerprints of ``marks(fp)`` that keep every component."""
    bounds = [64 * k // pieces for k in range(pieces + 1)]
    parts = [(1 << bounds[k + 1]) - (1 << bounds[k]) for k in range(pieces)]
    masks = [sum(c) for c in combinations(parts, pieces - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    # A bucket's name is hashed: two that share a hash are compared together, which loses nothing.
    filed = marks.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long")))
        for k, m in enumerate(signed)
    ))).alias("bucket"))
    crowded = written(filed.groupBy("bucket").agg(F.count("*").alias("n")).where(f"n > {tile}").select(
        "bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles")
    ), "crowded")
    dealt = filed.join(crowded, "bucket", "left").select(
        "fp", "bucket", "tiles", F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")).alias("own"),
    ).select(
        "fp", "bucket", "own",
        F.explode(F.expr(
            "CASE WHEN tiles IS NULL THEN array(CAST(NULL AS BIGINT))"
            " ELSE array_remove(transform(sequence(0, tiles - 1), x -> CAST(x AS BIGINT)), own) END"
        )).alias("other"),
    ).select(
        F.when(F.col("other").isNull(), F.col("bucket")).otherwise(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
        ).alias("bucket"), "fp",
    )
    by_bucket = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(partial(_linked, radius=radius), "a long, b long")


def _components(marked: DataFrame, radius: int, pieces: int) -> DataFrame:
    """(class, component, first): each fingerprint, the one that names its component, and the first
    row in it by id, null ids last, then by hash of the text. A written table."""
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h")
    classes = written(marked.groupBy("fp").agg(F.min(row).alias("own")), "classes")
    named = components(links(classes.select("fp"), radius, pieces)).withColumnRenamed("node", "fp")
    inside = classes.join(named, "fp", "left").select(
        "fp", "own", F.coalesce("component", "fp").alias("component")
    )
    inside = written(inside, "inside")
    first = inside.groupBy("component").agg(F.min("own").alias("first"))
    # Written, so that both sides of the next join are plain exchanges and a hot class can be split.
    return written(
        inside.join(first, "component").select(F.col("fp").alias("class"), "component", "first"), "components"
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, pieces: int = 6,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest id reachable by links."""
    marked = written(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    every = _components(marked, radius, pieces)
    return marked.join(every, F.col("fp") == F.col("class")).select(
        "doc_id", "fp", F.col("first.doc_id").alias("component_id")
    )


def keep_one(
    docs: DataFrame, shingle: int = 4, radius: int = 4, pieces: int = 6,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns."""
    marked = written(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    firsts = _components(marked, radius, pieces).select("first").distinct()
    times = marked.groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    keepers = written(firsts.select(F.col("first.doc_id").alias("keeper"), F.col("first.h").alias("of")).join(
        times, F.col("keeper").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("h"))
    ).select("keeper", "of", "n"), "keepers")
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_column).cast("string"), F.lit(""))).alias("h"),
        F.struct("*").alias("row"),
    )
    same = F.col("id").eqNullSafe(F.col("keeper")) & (F.col("h") == F.col("of"))
    once = rows.join(keepers.where("n = 1"), same, "left_semi").select("row.*")
    # Rows equal in id and text are few or combine before the shuffle; a written table is small
    # enough to be told from its files.
    several = written(keepers.where("n > 1"), "several")
    again = rows.join(several, same, "left_semi").groupBy("id", "h").agg(
        F.min_by("row", F.xxhash64("row")).alias("row")
    ).select("row.*")
    return once.union(again)


def op1_simhash(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs, shingle=4, radius=4, pieces=6)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
