"""Removal of byte strings that already start in a document with a smaller id.

Strings of ``WINDOW`` bytes are compared by a suffix ordering whose buckets are refined by pointers:
suffixes are bucketed by their first q bytes, then buckets are split by the bucket of the suffix q
bytes further on, which doubles the depth, and each round's buckets serve the next one. Suffixes that
are alone in their bucket are left out of later rounds.

Not every suffix of the corpus can be moved to be ordered. A window is named by its anchor, the least
hash of the q-grams inside it; equal windows have equal anchors at the same place in them. So:

1. Documents are laid end to end in blocks, one row per block, in a table bucketed by block, which
   later steps read without a shuffle: a text is never moved. Exact copies are found by the digests in
   the blocks; a block leaves them out of what follows and gives them back as wholly removed.
2. Every block tells, per part of the hash range, its distinct anchors with their smallest document;
   a part answers with one bit each: does the anchor occur in another document?
3. Of anchors that do, every block sends the bytes around them, equal ones once with their smallest
   document. A part orders all windows in them by bucket pointers and answers with one bit per
   window: does it start in a document with a smaller id?
4. Every block marks the bytes covered by such windows.

A hot anchor or passage sends at most one entry per block and distinct context, however many
documents hold it. Parts are sized by the bytes of the table and are worked through in slices of the
hash range, so that messages, one per block and part, stay few beside their content while a task sorts
little at once. Anchors only choose what is compared; the decision rests on the bytes.

Defined results: a null text counts as empty. Nothing is removed from documents shorter than a
window. Rows with a null id keep everything and take nothing from others. Rows that share an id do
not affect each other. Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import scratch_path, written

WINDOW = 50
GRAM = 20  # bytes of an anchor
FIRST = 8  # bytes that the first buckets are made of
BLOCK_BYTES = 4 << 20
SEGMENT = 1 << 20  # a longer block is searched for anchors by segments
RUNS = 1 << 14  # anchors whose windows are marked at once
PART_BYTES = 16 << 20
SLICES = 4  # of a part's hash range, each ordered by itself
PLACE_BITS = 24
PAIRED = np.uint64(0xBF58476D1CE4E5B9)
MIXED = np.uint64(0x9E3779B97F4A7C15)
NOTHING = hashlib.sha256(b"").hexdigest()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * PAIRED
    return x ^ (x >> np.uint64(31))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place: of two halves, of two quarters, of five bytes."""
    n = len(data) - GRAM + 1
    h = np.zeros(len(data) - 4, dtype=np.uint64)
    for k in range(5):
        h |= data[k:len(data) - 4 + k].astype(np.uint64) << np.uint64(8 * k)
    h = _mix(h + MIXED)
    for step in (5, 10):
        h = _mix(h[:-step] * MIXED + h[step:])
    return h[:n]


def _least_grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the least gram of every window; ``data`` is at most a segment long."""
    grams = _gram_hashes(data)
    # The place in the low bits settles ties: the first of equal grams.
    room = (np.uint64(1) << np.uint64(PLACE_BITS)) - np.uint64(1)
    key = (grams & ~room) | np.arange(len(grams), dtype=np.uint64)
    span, least, width = WINDOW - GRAM + 1, key, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:len(key) - span + 1], least[span - width:])
    at = (least & room).astype(np.int64)
    return at, grams[at]


class Anchors:
    """Where the windows of one block have their anchors.

    ``place`` is an anchor's first byte, ``low`` and ``high`` the first and last window that it names;
    all are places in the block. ``hash`` is the anchor's hash and ``doc`` its document's number.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        empty = np.zeros(0, dtype=np.int64)
        self.place = self.low = self.high = self.doc = empty
        self.hash = np.zeros(0, dtype=np.uint64)
        if len(data) < WINDOW:
            return
        found = []
        for a in range(0, len(data) - WINDOW + 1, SEGMENT):
            at, grams = _least_grams(data[a:a + SEGMENT + WINDOW - 1])  # of the window that starts here
            start = np.arange(a, a + len(at))
            doc = np.searchsorted(ends, start, side="right")
            inside = start + WINDOW <= ends[doc]
            at, start, doc, grams = at[inside] + a, start[inside], doc[inside], grams[inside]
            if not len(at):
                continue
            cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
            run = [at[cut], start[cut], start[np.r_[cut[1:] - 1, len(start) - 1]], doc[cut], _mix(grams[cut])]
            if found and found[-1][0][-1] == run[0][0] and found[-1][2][-1] + 1 == run[1][0]:
                # The windows of one anchor on both sides of the segment's end.
                found[-1][2][-1] = run[2][0]
                run = [x[1:] for x in run]
                if not len(run[0]):
                    continue
            found.append(run)
        if found:
            self.place, self.low, self.high, self.doc, self.hash = map(np.concatenate, zip(*found))


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _distinct(anchors: Anchors, ids: np.ndarray):
    """(hash, smallest id, in several documents) of a block's distinct anchors, by hash."""
    order = np.argsort(anchors.hash, kind="stable")
    hashes, own = anchors.hash[order], ids[anchors.doc[order]]
    if not len(hashes):
        return hashes, own, np.zeros(0, dtype=bool), order, np.zeros(0, dtype=np.int64)
    new = np.r_[True, hashes[1:] != hashes[:-1]]
    cut = np.flatnonzero(new)
    smallest, largest = np.minimum.reduceat(own, cut), np.maximum.reduceat(own, cut)
    return hashes[cut], smallest, smallest != largest, order, np.cumsum(new) - 1


def _block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(bytes, lengths, ids, bytes as such) of a block's documents that are no copies."""
    data, lengths, ids = row["data"], np.array(row["lengths"], dtype=np.int64), np.array(row["ids"], dtype=np.int64)
    if row["copies"]:
        stays = np.ones(len(ids), dtype=bool)
        stays[row["copies"]] = False
        ends = np.cumsum(lengths)[stays].tolist()
        lengths, ids = lengths[stays], ids[stays]
        data = b"".join(data[end - n:end] for end, n in zip(ends, lengths.tolist()))
    return np.frombuffer(data, np.uint8), lengths, ids, data


def _rows(batches):
    """Rows of Arrow batches one at a time: a block is large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _lay_out(batches, block_bytes: int):
    """Documents end to end in blocks of about ``block_bytes``."""
    def block(ids, texts):
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([[hashlib.sha256(t).digest() for t in texts]], pa.list_(pa.binary())),
            pa.array([b"".join(texts)], pa.binary()),
        ], ["block", "ids", "lengths", "digests", "data"])

    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py().encode())
            held += len(texts[-1])
            if held >= block_bytes:
                yield block(ids, texts)
                ids, texts, held = [], [], 0
    if ids:
        yield block(ids, texts)


def _messages(fine: np.ndarray):
    """(part, first, end, entries per slice as bytes) of every part in ``fine``, the entries' slices in order."""
    part = fine // SLICES
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, dtype=np.int64)
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        p = int(part[a])
        yield p, a, b, np.bincount(fine[a:b] - p * SLICES, minlength=SLICES).astype("<u4").tobytes()


def _tell_anchors(batches, parts: int):
    """Per block and part: the low six bytes of its anchors' hashes, smallest ids, and several-bits."""
    for row in _rows(batches):
        data, lengths, ids, _ = _block(row)
        hashes, smallest, several, _, _ = _distinct(Anchors(data, lengths), ids)
        out = []
        for p, a, b, slices in _messages(_part_of(hashes, parts * SLICES)):
            low = smallest[a:b].min()
            short = np.ascontiguousarray(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
            offset = smallest[a:b] - low
            kind = "<u4" if offset.max() < 1 << 32 else "<u8"
            out.append((row["block"], p, b - a, slices, short.tobytes(), int(low),
                        offset.astype(kind).tobytes(), np.packbits(several[a:b]).tobytes()))
        columns = list(zip(*out)) if out else [[]] * 8
        yield pa.RecordBatch.from_arrays([
            pa.array(list(c), t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()
            ))
        ], ["block", "part", "n", "slices", "hashes", "low", "ids", "several"])


def _slice_ends(table: pa.Table) -> np.ndarray:
    """Per message the first entry of each slice, and the end of the last."""
    sizes = np.array([np.frombuffer(x, "<u4") for x in table.column("slices").to_pylist()], dtype=np.int64)
    return np.hstack([np.zeros((len(sizes), 1), dtype=np.int64), np.cumsum(sizes, axis=1)])


def _answers(table: pa.Table, counts: np.ndarray, bits: np.ndarray) -> pa.Table:
    cuts = np.r_[0, np.cumsum(counts)]
    packed = [np.packbits(bits[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table({
        "block": table.column("block"), "part": table.column("part"),
        "n": pa.array(counts, pa.int64()), "bits": pa.array(packed, pa.binary()),
    })


def _find_shared(table: pa.Table) -> pa.Table:
    """One bit per anchor of each block: it occurs in more than one document of the corpus."""
    counts, ends = table.column("n").to_numpy(), _slice_ends(table)
    messages = list(zip(counts.tolist(), *(
        table.column(c).to_pylist() for c in ("hashes", "low", "ids", "several")
    )))
    begin = np.r_[0, np.cumsum(counts)[:-1]]
    bits = np.empty(int(counts.sum()), dtype=bool)
    for s in range(SLICES):
        hashes, ids, several, places = [], [], [], []
        for (n, h, low, own, many), at, a, b in zip(
            messages, begin.tolist(), ends[:, s].tolist(), ends[:, s + 1].tolist()
        ):
            wide = np.zeros((b - a, 8), dtype=np.uint8)
            wide[:, :6] = np.frombuffer(h, np.uint8).reshape(-1, 6)[a:b]
            hashes.append(wide.view("<u8").ravel())
            ids.append(np.frombuffer(own, "<u4" if len(own) == 4 * n else "<u8")[a:b].astype(np.int64) + low)
            several.append(np.unpackbits(np.frombuffer(many, np.uint8), count=n)[a:b].astype(bool))
            places.append(np.arange(at + a, at + b))
        hashes, ids, several, places = map(np.concatenate, (hashes, ids, several, places))
        if not len(hashes):
            continue
        order = np.argsort(hashes, kind="stable")
        new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        cut = np.flatnonzero(new)
        own = ids[order]
        shared = (np.minimum.reduceat(own, cut) != np.maximum.reduceat(own, cut)) | (
            np.maximum.reduceat(several[order], cut)
        )
        bits[places[order]] = shared[np.cumsum(new) - 1]
    return _answers(table, counts, bits)


def _bits(answers: list, parts: int) -> np.ndarray:
    """The answers to a block in the order of its parts."""
    return np.concatenate([np.zeros(0, dtype=bool)] + [
        np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]).astype(bool)
        for a in sorted(answers, key=lambda a: a["part"])
    ])


def _contexts(row: dict, parts: int):
    """A block's anchors that are shared, and the distinct bytes around them.

    Returns (anchors, chosen, context, texts, smallest, part): ``context`` numbers each chosen
    anchor's context; contexts are ordered by the slice of their part.
    """
    data, lengths, ids, raw = _block(row)
    anchors = Anchors(data, lengths)
    hashes, _, _, order, which = _distinct(anchors, ids)
    shared = _bits(row["answers"] or [], parts)
    chosen = np.sort(order[shared[which]]) if len(shared) else order[:0]
    # By slice, and inside a slice in the order of the text.
    part = _part_of(anchors.hash[chosen], parts * SLICES)
    by_part = np.argsort(part, kind="stable")
    chosen, part = chosen[by_part], part[by_part]
    numbers: dict[bytes, int] = {}
    texts, owners, homes = [], [], []
    context = np.empty(len(chosen), dtype=np.int64)
    own = ids[anchors.doc[chosen]]
    for k, (a, b, doc, p) in enumerate(zip(
        anchors.low[chosen].tolist(), (anchors.high[chosen] + WINDOW).tolist(), own.tolist(), part.tolist()
    )):
        text = raw[a:b]
        number = numbers.setdefault(text, len(texts))
        if number == len(texts):
            texts.append(text)
            owners.append(doc)
            homes.append(p)
        elif doc < owners[number]:
            owners[number] = doc
        context[k] = number
    return anchors, chosen, context, texts, np.array(owners, dtype=np.int64), np.array(homes, dtype=np.int64)


def _tell_contexts(batches, parts: int):
    for row in _rows(batches):
        _, _, _, texts, owners, homes = _contexts(row, parts)
        out = []
        for p, a, b, slices in _messages(homes):
            lengths = np.array([len(t) for t in texts[a:b]], dtype="<u2")
            out.append((row["block"], p, slices, lengths.tobytes(), owners[a:b].astype("<i8").tobytes(),
                        b"".join(texts[a:b])))
        columns = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([
            pa.array(list(c), t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()
            ))
        ], ["block", "part", "slices", "lengths", "ids", "data"])


def bucket_windows(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, buckets): all windows of the texts that end at ``ends``; equal ones share a bucket."""
    n = len(data)
    left = np.repeat(ends, np.diff(np.r_[0, ends])) - np.arange(n)  # bytes to the end of the text
    bucket = np.full(n, -1, dtype=np.int64)
    active = np.flatnonzero(left >= FIRST)
    grams = np.zeros(max(0, n - FIRST + 1), dtype=np.uint64)
    for k in range(FIRST):
        grams |= data[k:n - FIRST + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    _, found, sizes = np.unique(grams[active], return_inverse=True, return_counts=True)
    bucket[active] = found
    following = len(sizes)
    active = active[sizes[found] > 1]
    depth = FIRST
    while depth < WINDOW:
        deeper = min(2 * depth, WINDOW)
        active = active[left[active] >= deeper]
        pair = bucket[active] * following + bucket[active + (deeper - depth)]
        _, found, sizes = np.unique(pair, return_inverse=True, return_counts=True)
        # Split buckets get numbers of their own; those alone in a bucket keep theirs.
        bucket[active] = following + found
        following += len(sizes)
        active = active[sizes[found] > 1]
        depth = deeper
    places = np.flatnonzero(left >= WINDOW)
    return places, bucket[places]


def _order_contexts(table: pa.Table) -> pa.Table:
    """One bit per window of each block's contexts: it starts in a document with a smaller id."""
    lengths = [np.frombuffer(x, "<u2").astype(np.int64) for x in table.column("lengths").to_pylist()]
    ids = [np.frombuffer(x, "<i8") for x in table.column("ids").to_pylist()]
    texts, ends = table.column("data").to_pylist(), _slice_ends(table)
    counts = np.array([int((x - WINDOW + 1).sum()) for x in lengths])
    bits, at = np.empty(int(counts.sum()), dtype=bool), np.r_[0, np.cumsum(counts)[:-1]]
    read = np.zeros(len(texts), dtype=np.int64)  # bytes of each message that earlier slices took
    for s in range(SLICES):
        spans = list(zip(range(len(texts)), ends[:, s].tolist(), ends[:, s + 1].tolist()))
        sizes = [lengths[m][a:b] for m, a, b in spans]
        taken = [int(x.sum()) for x in sizes]
        raw = b"".join(texts[m][r:r + n] for m, (r, n) in enumerate(zip(read.tolist(), taken)))
        read += taken
        every = np.concatenate(sizes)
        if not len(every):
            continue
        verdict = _order_slice(raw, every, np.concatenate([ids[m][a:b] for m, a, b in spans]))
        done = 0
        for m, x in enumerate(sizes):
            n = int((x - WINDOW + 1).sum())
            bits[at[m]:at[m] + n] = verdict[done:done + n]
            at[m] += n
            done += n
    return _answers(table, counts, bits)


def _order_slice(raw: bytes, every: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One bit per window of contexts with ``every`` bytes: it starts in a document with a smaller id."""
    # Equal contexts of several blocks are ordered once, for the smallest of their documents.
    at, numbers = 0, {}
    which = np.empty(len(every), dtype=np.int64)
    for k, n in enumerate(every.tolist()):
        which[k] = numbers.setdefault(raw[at:at + n], len(numbers))
        at += n
    sizes = np.array([len(t) for t in numbers])
    owners = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(owners, which, ids)
    _, bucket = bucket_windows(np.frombuffer(b"".join(numbers), np.uint8), np.cumsum(sizes))
    own = np.repeat(owners, sizes - WINDOW + 1)
    order = np.argsort(bucket, kind="stable")
    new = np.r_[True, bucket[order][1:] != bucket[order][:-1]]
    smallest = np.empty(len(own), dtype=np.int64)
    smallest[order] = np.minimum.reduceat(own[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    # Each block's windows look up those of their context.
    times = every - WINDOW + 1
    begin = np.r_[0, np.cumsum(sizes - WINDOW + 1)[:-1]]
    window = np.repeat(begin[which], times) + (
        np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    )
    return smallest[window] < np.repeat(ids, times)


def _remove(batches, parts: int, with_text: bool):
    """Per document of each block: the bytes to remove, as runs, and what is kept."""
    for row in _rows(batches):
        data, lengths, ids, raw = _block(row)
        gone = np.zeros(len(data), dtype=bool)
        anchors, chosen, context, texts, owners, _ = _contexts(row | {"answers": row["shared"]}, parts)
        windows = np.array([len(t) - WINDOW + 1 for t in texts], dtype=np.int64)
        del texts
        if len(chosen):
            verdict = _bits(row["covered"] or [], parts)
            begin = np.r_[0, np.cumsum(windows)[:-1]]
            for k in range(0, len(chosen), RUNS):
                some, its = chosen[k:k + RUNS], context[k:k + RUNS]
                times = windows[its]
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                start = np.repeat(anchors.low[some], times) + step
                later = np.repeat(ids[anchors.doc[some]] > owners[its], times)
                gone[start[verdict[np.repeat(begin[its], times) + step] | later]] = True
        width = 1  # a covered window marks its first byte, then all of its bytes
        while width < WINDOW:
            step = min(width, WINDOW - width)
            gone[step:] |= gone[:-step].copy()
            width += step
        out = [
            (row["ids"][k], row["lengths"][k], row["lengths"][k], 1, NOTHING, b"" if with_text else None)
            for k in row["copies"] or []
        ]
        at = 0
        for doc_id, n in zip(ids.tolist(), lengths.tolist()):
            mask = gone[at:at + n]
            kept = data[at:at + n][~mask].tobytes() if mask.any() else raw[at:at + n]
            spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
            digest = hashlib.sha256(kept).hexdigest()
            out.append((doc_id, n, n - len(kept), spans, digest, kept if with_text else None))
            at += n
        columns = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([
            pa.array(list(c), t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()
            ))
        ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def deduplicate(docs: DataFrame, with_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept`` are the bytes left."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    long = (F.octet_length("text") >= WINDOW) & F.col("doc_id").isNotNull()

    name, buckets = f"llm_blocks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.where(long).mapInArrow(
        partial(_lay_out, block_bytes=block_bytes),
        "block long, ids array<long>, lengths array<long>, digests array<binary>, data binary",
    ).write.bucketBy(buckets, "block").option("path", scratch_path(spark, name)).saveAsTable(name)
    laid = spark.table(name)
    seen = laid.select("block", F.posexplode(F.arrays_zip("ids", "lengths", "digests")).alias("place", "doc")).select(
        "block", "place", F.col("doc.ids").alias("doc_id"), F.col("doc.lengths").alias("n"),
        F.col("doc.digests").alias("digest"),
    )
    total = seen.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = written(seen.join(first.where("first < last"), "digest").where("doc_id > first").groupBy("block").agg(
        F.collect_list("place").alias("copies")
    ), "copies")
    blocks = laid.select("block", "ids", "lengths", "data").join(copies.hint("shuffle_hash"), "block", "left")

    def answered(told: DataFrame, by, column: str) -> DataFrame:
        replies = told.groupBy("part").applyInArrow(by, "block long, part long, n long, bits binary")
        return written(replies.groupBy("block").agg(
            F.collect_list(F.struct("part", "n", "bits")).alias(column)
        ), column)

    shared = answered(blocks.mapInArrow(
        partial(_tell_anchors, parts=parts),
        "block long, part long, n long, slices binary, hashes binary, low long, ids binary, several binary",
    ), _find_shared, "shared")
    asked = blocks.join(shared.hint("shuffle_hash"), "block")
    covered = answered(asked.withColumnRenamed("shared", "answers").mapInArrow(
        partial(_tell_contexts, parts=parts), "block long, part long, slices binary, lengths binary, ids binary, data binary"
    ), _order_contexts, "covered")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cleaned = blocks.join(shared.hint("shuffle_hash"), "block", "left").join(
        covered.hint("shuffle_hash"), "block", "left"
    ).mapInArrow(partial(_remove, parts=parts, with_text=with_text), result)

    zero = F.lit(0).cast("long")
    untouched = rows.where(~long).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        (F.encode("text", "UTF-8") if with_text else F.lit(None).cast("binary")).alias("kept"),
    )
    return cleaned.unionByName(untouched)


def op2_suffix_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicate(docs, with_text=False).drop("kept")
