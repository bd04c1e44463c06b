"""Conversation structure repair: rank-convergence parallel Viterbi over chunks of rows.

Every row of a conversation is kept, given another role or deleted, and rows without text may be
inserted, so that the roles form ``(s?(ua)+)?`` (an optional system row, then pairs of user and
assistant) at the least cost, the ASCII-least row of edit letters among equals. The search is a
Viterbi pass over four states: nothing yet, after system, after user, after assistant.

A conversation can be longer than a task should hold, so its rows, one byte each, are cut into chunks.
Costs run backwards: the cost still to come from each state. A chunk does not know the costs at its
end, starts from a speculative vector (that of a conversation's end) and keeps what it finds at its
start. Fix-up passes then hand every chunk what its successor found: where that differs from what the
chunk was given by more than a constant, the chunk runs old and new vectors side by side from its end
and stops at the first row where both differ only by a constant; from there on the old result holds,
shifted. Passes end once no chunk was given another vector. The stitched costs then drive the trace:
every chunk is traced from each state it may be entered in, always by the least letter that
keeps the cost, and the chunks' few exits are chained.

Scale: only sizes and hashes of texts travel through the search; the rows are dealt by ranges of
(conversation, place), so one conversation may span any number of tasks. Texts move once, for the
repaired rows. There a conversation's rows pass one task as a stream, because a SHA-256 is sequential;
that task holds a byte a row and no texts.

Defined results: a null role or text counts as one space. Rows of one turn go by role, then by the
SHA-256 of the text. Turns that are null come first. A null id is a conversation of its own. Equal
rows are rows of their own, the later ones duplicates. An initial other than s, u and a fits
nowhere. Extra columns are left alone. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.common import written

BLANK = r"[^\x20\x09-\x0D]"
UNFINISHED = r"[.!?][\x20\x09-\x0D]*\z"  # a text without it is truncated
CHUNK = 1 << 16  # rows of one conversation that are searched together

# Fixed values of the contract: costs of the edits, and what an unfinished kept row adds.
DELETE, INSERT, KEEP, REROLE = 2, 5, 0, 1
TRUNCATED = 5

START, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired rows so far end with
ACCEPTING = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAULTS = ["none", "truncated", "blank", "duplicate"]  # a symbol is 4 * class + fault
CLASSES = "sua"  # initials; the fourth class is any other
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _next(state: int) -> int:
    """The state after the one row of user or assistant that may follow ``state``."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, kind: int) -> int | None:
    """The state after a kept row of that class, None where it does not fit."""
    if kind == 0:
        return SYSTEM if state == START else None
    return _next(state) if kind == _next(state) - 1 else None


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to come when rows may also be inserted first: two in a row at most, a cycle never pays."""
    user, assistant = costs[USER], costs[ASSISTANT]
    after_user = min(user, INSERT + assistant)
    return (
        min(costs[START], INSERT + after_user), min(costs[SYSTEM], INSERT + after_user),
        after_user, min(assistant, INSERT + user),
    )


FAR = 1 << 40
FINAL = _closed([0 if q in ACCEPTING else FAR for q in range(4)])


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row, by letter."""
    kind, fault = divmod(symbol, 4)
    out = [("D", DELETE, state)]
    if fault < 2:
        kept = _kept(state, kind)
        if kept is not None:
            out.append(("K", KEEP + TRUNCATED * fault, kept))
        out.append(("R", REROLE + TRUNCATED * fault, _next(state)))
    return out


class Costs:
    """Backward steps and traced edits, remembered: vectors less their least entry are few."""

    def __init__(self):
        self.steps: dict = {}
        self.edits: dict = {}

    def back(self, vector: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int]:
        """(costs before the row less their least entry, that entry)."""
        found = self.steps.get((vector, symbol))
        if found is None:
            before = _closed([
                min(cost + vector[to] for _, cost, to in _choices(symbol, q)) for q in range(4)
            ])
            least = min(before)
            found = self.steps[vector, symbol] = tuple(c - least for c in before), least
        return found

    def edit(self, vector: tuple[int, ...], symbol: int, state: int) -> tuple[str, int, int]:
        """(least letters up to and with this row's, their cost, next state); ``vector`` follows it."""
        found = self.edits.get((vector, symbol, state))
        if found is None:
            before, least = self.back(vector, symbol)
            letters, cost, q = "", 0, state
            while True:
                options = [(x, c, to, vector[to]) for x, c, to in _choices(symbol, q)]
                options.append(("I", INSERT, _next(q), before[_next(q)] + least))
                letter, spent, to, _ = min(
                    o for o in options if o[1] + o[3] == before[q] + least
                )
                letters, cost, q = letters + letter, cost + spent, to
                if letter != "I":
                    break
            found = self.edits[vector, symbol, state] = letters, cost, q
        return found

    def run(self, symbols: bytes, end: tuple[int, ...]) -> tuple[int, ...]:
        """Costs at the chunk's start, less their least entry."""
        vector, back = end, self.back
        for symbol in reversed(symbols):
            vector = back(vector, symbol)[0]
        return vector

    def fix_up(self, symbols: bytes, old_end, new_end, old_start) -> tuple[tuple[int, ...], int]:
        """(costs at the start for the new end, rows run until old and new were parallel)."""
        old, new, back = old_end, new_end, self.back
        for done, symbol in enumerate(reversed(symbols)):
            if old == new:  # both are less their least entry: equal means parallel
                return old_start, done
            old, new = back(old, symbol)[0], back(new, symbol)[0]
        return new, len(symbols)

    def trace(self, symbols: bytes, end: tuple[int, ...], last: bool, state: int):
        """(letters, cost, exit state) of the least audit from ``state``."""
        vectors, vector = [], end
        for symbol in reversed(symbols):
            vectors.append(vector)
            vector = self.back(vector, symbol)[0]
        out, total = [], 0
        for symbol, following in zip(symbols, reversed(vectors)):
            letters, cost, state = self.edit(following, symbol, state)
            out.append(letters)
            total += cost
        while last and state not in ACCEPTING:
            out.append("I")
            total += INSERT
            state = _next(state)
        return "".join(out), total, state


def normal(vector) -> tuple[int, ...]:
    least = min(vector)
    return tuple(int(c) - int(least) for c in vector)


def _named(rows: DataFrame, id_column, turn_column, role_column, text_column) -> DataFrame:
    """(conv_id, turn, role, text) with null roles and texts as one space."""
    space = F.lit(" ")
    return rows.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), space).alias("text"),
    )


def _text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


PLACE = ["conv_id", "turn", "role", "digest"]  # the order of rows


def _marks(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, symbol, salt): rows without their texts, first faults known."""
    kind = F.instr(F.lit(CLASSES), F.substring("role", 1, 1))
    seen = written(rows.select(
        "conv_id", "turn", "role", _text_digest(F.col("text")).alias("digest"),
        F.when(F.substring("role", 1, 1) == "", 3).when(kind == 0, 3).otherwise(kind - 1).alias("kind"),
        F.when(~F.col("text").rlike(BLANK), 2).when(F.col("text").rlike(UNFINISHED), 0)
        .otherwise(1).alias("fault"),
    ), "rows").withColumn("salt", F.monotonically_increasing_id())
    # Which of equal rows comes first is settled once per text that occurs again, not per row.
    place = F.struct(F.col("turn").isNotNull(), "turn", "salt")
    again = written(
        seen.groupBy("conv_id", "role", "digest")
        .agg(F.count("*").alias("times"), F.min(place).alias("first"))
        .where("times > 1").select(
            F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
        ), "again",
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
        & (F.col("digest") == F.col("d"))
    )
    fault = F.when(F.col("fault") == 2, 2).when(place > F.col("first"), 3).otherwise(F.col("fault"))
    return seen.join(again, same, "left").select(
        *PLACE, "salt", (F.col("kind") * 4 + fault).cast("tinyint").alias("symbol")
    )


def _cut_chunks(batches, chunk: int) -> Iterator[pa.RecordBatch]:
    """Runs of one conversation in a sorted partition, ``chunk`` symbols at most, numbered."""
    number, held, current = 0, bytearray(), None
    out: list = []
    for batch in batches:
        part = batch.column(2)[0].as_py() if len(batch) else 0
        symbols = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
        for owner, symbol in zip(batch.column(0).to_pylist(), symbols):
            if current is not None and (owner != current[0] or len(held) >= chunk):
                out.append((current[0], current[1], number, bytes(held)))
                number, held = number + 1, bytearray()
            current = (owner, part)
            held.append(symbol)
        if len(out) >= 1024:
            yield _chunk_batch(out, batch.schema.field(0).type)
            out = []
        kind = batch.schema.field(0).type
    if current is not None:
        out.append((current[0], current[1], number, bytes(held)))
    if out:
        yield _chunk_batch(out, kind)


def _chunk_batch(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], ["conv_id", "part", "number", "symbols"]
    )


def _chunks(marks: DataFrame, chunk: int) -> DataFrame:
    """(conv_id, k, last, follower, symbols): a conversation's chunks in order, k from 0."""
    kind = marks.schema["conv_id"].dataType.simpleString()
    ordered = marks.repartitionByRange(
        F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "digest", "salt"
    ).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "salt")
    cut = ordered.select("conv_id", "symbol", F.spark_partition_id().alias("part")).mapInArrow(
        partial(_cut_chunks, chunk=chunk), f"conv_id {kind}, part int, number long, symbols binary"
    )
    in_order = Window.partitionBy("conv_id").orderBy("part", "number")  # one row per ``chunk`` rows
    return written(written(cut, "cut").select(
        "conv_id", (F.row_number().over(in_order) - 1).cast("long").alias("k"),
        F.lead("number").over(in_order).isNull().alias("last"),
        F.lead(F.substring("symbols", 1, 1)).over(in_order).alias("follower"), "symbols",
    ), "chunks")


VECTOR = "array<int>"


def _first_pass(batches) -> Iterator[pa.RecordBatch]:
    costs = Costs()
    for batch in batches:
        starts = [costs.run(s.as_py(), FINAL) for s in batch.column(4)]
        n = len(batch)
        yield pa.RecordBatch.from_arrays([
            *batch.columns, pa.array([list(FINAL)] * n, pa.list_(pa.int32())),
            pa.array([list(s) for s in starts], pa.list_(pa.int32())), pa.array([0] * n, pa.int64()),
        ], ["conv_id", "k", "last", "follower", "symbols", "end", "start", "rerun"])


def _fix_pass(batches) -> Iterator[pa.RecordBatch]:
    """Chunks whose follower found another vector are run again until old and new are parallel."""
    costs = Costs()
    for batch in batches:
        ends, starts, runs = [], [], []
        for symbols, end, start, given in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6, 7))):
            end, start, given = tuple(end), tuple(start), normal(given or end)
            rows = 0
            if given != normal(end):
                start, rows = costs.fix_up(symbols, normal(end), given, start)
                end = given
            ends.append(list(end))
            starts.append(list(start))
            runs.append(rows)
        vectors = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:5], pa.array(ends, vectors), pa.array(starts, vectors),
            pa.array(runs, pa.int64()),
        ], ["conv_id", "k", "last", "follower", "symbols", "end", "start", "rerun"])


def stitched(chunks: DataFrame) -> DataFrame:
    """``chunks`` with the costs to come at each one's ``end``, right up to a constant."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, k long, last boolean, follower binary, symbols binary, end {VECTOR},"
        f" start {VECTOR}, rerun long"
    )
    vectors = [F.lit(list(FINAL)).cast(VECTOR).alias(c) for c in ("end", "start")]
    alone = chunks.where("last AND k = 0").select("*", *vectors, F.lit(0).cast("long").alias("rerun"))
    split = chunks.where("NOT (last AND k = 0)")
    current = written(split.mapInArrow(_first_pass, schema), "pass")
    while True:
        given = current.select(
            F.col("conv_id").alias("c"), (F.col("k") - 1).alias("before"), F.col("start").alias("given")
        )
        known = current.drop("rerun").join(
            given, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("k") == F.col("before")), "left"
        ).drop("c", "before")
        current = written(known.mapInArrow(_fix_pass, schema), "pass")
        if not current.agg(F.sum("rerun")).first()[0]:
            return alone.union(current)


def _trace_pass(batches) -> Iterator[pa.RecordBatch]:
    """Per chunk: faults, illegal neighbours, and letters, cost and exit for each state of entry."""
    costs = Costs()
    names = ["conv_id", "k", "blank", "duplicate", "truncated", "illegal", "ways"]
    way = pa.list_(pa.struct([("letters", pa.string()), ("cost", pa.int64()), ("exit", pa.int32())]))
    for batch in batches:
        counts, ways = [], []
        columns = (batch.column(i).to_pylist() for i in range(1, 6))
        for k, last, follower, symbols, end in zip(*columns):
            row = np.frombuffer(symbols + (follower or b""), dtype=np.uint8)
            fault = np.bincount(row[:len(symbols)] % 4, minlength=4)
            kinds = (row // 4).tolist()
            illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))
            counts.append((fault[2], fault[3], fault[1], illegal))
            states = range(4) if k else [START]
            ways.append([
                dict(zip(("letters", "cost", "exit"), costs.trace(symbols, normal(end), last, q)))
                for q in states
            ])
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:2], *(pa.array(list(c), pa.int64()) for c in zip(*counts)),
            pa.array(ways, way),
        ], names)


def _chain(key, frame: pd.DataFrame) -> pd.DataFrame:
    """State of entry of each chunk of one conversation; a row per chunk of rows."""
    frame = frame.sort_values("k", ignore_index=True)
    state, entries = START, []
    for exits in frame["exits"]:
        entries.append(state)
        state = exits[state] if len(exits) > 1 else exits[0]
    return frame.assign(entry=entries).drop(columns=["exits"])


def audits(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", chunk: int = CHUNK,
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation with rows."""
    rows = _named(conversations, id_column, turn_column, role_column, text_column)
    marks = written(_marks(rows), "marks")
    kind = rows.schema["conv_id"].dataType.simpleString()
    traced = written(stitched(_chunks(marks, chunk)).mapInArrow(
        _trace_pass, f"conv_id {kind}, k long, blank long, duplicate long, truncated long,"
        " illegal long, ways array<struct<letters:string,cost:bigint,exit:int>>"
    ), "traced")
    several = traced.groupBy("conv_id").agg(F.max("k").alias("most")).where("most > 0").select(
        F.col("conv_id").alias("c")
    )
    split = traced.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    entries = split.select("conv_id", "k", F.col("ways.exit").alias("exits")).groupBy("conv_id").applyInPandas(
        _chain, f"conv_id {kind}, k long, entry int"
    ).toDF("c", "at", "entry")
    chosen = traced.join(
        entries, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("k") == F.col("at")), "left"
    ).withColumn("way", F.get("ways", F.coalesce("entry", F.lit(START))))
    searched = chosen.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
        F.sum("way.cost").alias("cost"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("k", "way.letters"))), lambda w: w["letters"]
        ), "").alias("audit"),
    )
    turns = marks.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)
        ).cast("long").alias("gaps")
    ).withColumnRenamed("conv_id", "c")
    return searched.join(turns, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def _apply(role: str, letter: str, state: int) -> tuple[str, int] | None:
    """(role of the repaired row, next state); None for a deleted one."""
    if letter == "D":
        return None
    if letter == "K":
        return role, SYSTEM if role.startswith("s") else _next(state)
    return ROLES[_next(state)], _next(state)


def _repaired_rows(batches, sink):
    """Walk (header, rows ...) of each conversation in a sorted stream; tells ``sink`` every letter.

    A header holds the audit; the rows behind it use one letter each, besides inserted ones.
    """
    audit, at, state = "", 0, START
    for batch in batches:
        columns = batch.to_pydict()
        for i, header in enumerate(columns["header"]):
            if header:
                if at < len(audit):
                    state = sink.rest(audit[at:], state)
                audit, at, state = columns["audit"][i] or "", 0, START
                sink.open({name: column[i] for name, column in columns.items()})
                continue
            while audit[at] == "I":
                at, state = at + 1, sink.insert(state)
            row = _apply(columns["role"][i], audit[at], state)
            if row:
                sink.keep(row[0], columns["text"][i], columns["turn"][i], audit[at])
                state = row[1]
            at += 1
        yield from sink.ready(False)
    if at < len(audit):
        sink.rest(audit[at:], state)
    yield from sink.ready(True)


class _Rows:
    """Collects repaired rows, batch by batch."""

    def __init__(self, id_type, turn_type):
        names = ["conv_id", "position", "turn", "role", "text", "edit"]
        types = [id_type, pa.int64(), turn_type, pa.string(), pa.string(), pa.string()]
        self.schema, self.rows = pa.schema(list(zip(names, types))), []

    def open(self, header):
        self.owner, self.position = header["conv_id"], 0

    def keep(self, role, text, turn, letter):
        self.rows.append((self.owner, self.position, turn, role, text, letter))
        self.position += 1

    def insert(self, state):
        self.keep(ROLES[_next(state)], "", None, "I")
        return _next(state)

    def rest(self, letters, state):
        for _ in letters:
            state = self.insert(state)
        return state

    def ready(self, end):
        if self.rows:
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*self.rows), self.schema)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


class _Digests(_Rows):
    """Hashes a conversation's ``role:text`` lines as they pass; a row per header."""

    def __init__(self, schema):
        self.schema, self.rows, self.header = schema, [], None

    def _close(self):
        if self.header is not None:
            self.rows.append(tuple(
                self.hash.hexdigest() if f.name == "repaired_sha256" else self.header[f.name]
                for f in self.schema
            ))

    def open(self, header):
        self._close()
        self.header, self.hash, self.first = header, hashlib.sha256(), True

    def keep(self, role, text, turn, letter):
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def ready(self, end):
        if end:
            self._close()
        yield from super().ready(end)


def _streamed(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Headers and rows of the conversations, each header before its rows in their order."""
    stats = [f for f in headers.schema if f.name != "conv_id"]
    body = rows.select(
        "conv_id", F.lit(False).alias("header"), "turn", "role", "text",
        _text_digest(F.col("text")).alias("digest"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in stats),
    )
    head = headers.select(
        "conv_id", F.lit(True).alias("header"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("digest"), *(f.name for f in stats),
    )
    return head.union(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("header").desc(), F.col("turn").asc_nulls_first(), "role", "digest"
    ).drop("digest")


def repair(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """(conv_id, position, turn, role, text, edit): the rows of the repaired conversations in order."""
    names = (id_column, turn_column, role_column, text_column)
    rows = _named(conversations, *names)
    stream = _streamed(rows, written(audits(conversations, *names).select("conv_id", "audit"), "audits"))

    def run(batches):
        first = next(batches, None)
        if first is not None:
            types = first.schema.field("conv_id").type, first.schema.field("turn").type
            yield from _repaired_rows(chain([first], batches), _Rows(*types))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return stream.mapInArrow(
        run, f"conv_id {kinds['conv_id']}, position long, turn {kinds['turn']}, role string,"
        " text string, edit string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the contract's damage by ``crc32(conv_id:turn) % 20``."""
    space = F.lit(" ")
    named = _named(conversations, "conv_id", "turn", "role", "text")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    drawn = named.withColumn("drawn", F.crc32(F.encode(key, "UTF-8")) % 20).where("drawn <> 0")
    return drawn.select(
        "conv_id", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def op12_conversations(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damaged(conversations)
    found = audits(rows).withColumnRenamed("conv_id", "c")
    every = conversations.select("conv_id").distinct()
    headers = written(every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *(F.coalesce(F.col(s), F.lit(0)).alias(s) for s in STATS),
        F.coalesce("audit", F.lit("")).alias("audit"),
    ), "headers")
    kind = headers.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", *STATS, "audit", "repaired_sha256"]

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        fields = [(c, pa.string() if c == "repaired_sha256" else first.schema.field(c).type) for c in columns]
        yield from _repaired_rows(chain([first], batches), _Digests(pa.schema(fields)))

    return _streamed(rows, headers).mapInArrow(
        run, f"conv_id {kind}, {', '.join(f'{s} long' for s in STATS)}, audit string, repaired_sha256 string"
    )


def _more(way: str, cost, letter: str, line: str) -> str:
    """SQL of a treatment with one more edit; treatments compare by cost, then by letters."""
    total = f"lpad(CAST(CAST(left({way}, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0')"
    end = f"strpos({way}, chr(1))"
    return (
        f"CASE WHEN {way} = '~' THEN '~' ELSE {total} || {way}[9:{end} - 1] || '{letter}'"
        f" || {way}[{end}:] || {line} END"
    )


NO_LINE = "''"
OP12_SQL = rf"""
WITH RECURSIVE
crc_steps(b, c, k) AS (
    SELECT b, b, 0 FROM range(256) r(b)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
    FROM crc_steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_steps WHERE k = 8),
named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
),
drawn AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(
        list_transform(range(0, length(k) + 1),
            lambda i: CASE WHEN i = 0 THEN 4294967295 ELSE ascii(k[i]) END),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
    ), 4294967295) % 20 AS d
    FROM named, crc_table
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM drawn, range(2) copies(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)
),
placed AS (
    SELECT *, row_number() OVER w AS i, left(role, 1) AS initial,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
        lag(left(role, 1)) OVER w || left(role, 1) AS pair
    FROM damaged
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), sha256(text))
),
faults AS (
    SELECT conv_id, turn, i, pair, initial, chr(10) || role || ':' || text AS line,
        chr(10) || 'user:' || text AS user_line, chr(10) || 'assistant:' || text AS assistant_line,
        CASE WHEN bare = '' THEN 'b'
            WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 'd'
            WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM placed
),
counts AS (
    SELECT conv_id, count(*) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
),
-- The cheapest treatment of the first i rows that ends at nothing, a system row, a user row or an
-- assistant row: eight digits of cost, letters, chr(1), repaired lines; '~' where there is none.
ways(conv_id, i, nothing, system, usr, assistant) AS (
    SELECT conv_id, 0::BIGINT, '00000000' || chr(1), '~', '00000005I' || chr(1) || chr(10) || 'user:',
        '00000010II' || chr(1) || chr(10) || 'user:' || chr(10) || 'assistant:'
    FROM counts
    UNION ALL
    SELECT conv_id, i, nothing, system, usr,
        least(assistant, {_more('usr', 5, 'I', "chr(10) || 'assistant:'")})
    FROM (
        SELECT conv_id, i, nothing, system, assistant,
            least(usr, {_more('least(nothing, system, assistant)', 5, 'I', "chr(10) || 'user:'")}) AS usr
        FROM (
            SELECT conv_id, i, {_more('nothing', 2, 'D', NO_LINE)} AS nothing,
                least({_more('system', 2, 'D', NO_LINE)}, CASE WHEN may AND initial = 's'
                    THEN {_more('nothing', 'extra', 'K', 'line')} ELSE '~' END) AS system,
                least({_more('usr', 2, 'D', NO_LINE)},
                    CASE WHEN may AND initial = 'u' THEN {_more('before', 'extra', 'K', 'line')} ELSE '~' END,
                    CASE WHEN may THEN {_more('before', '1 + extra', 'R', 'user_line')} ELSE '~' END) AS usr,
                least({_more('assistant', 2, 'D', NO_LINE)},
                    CASE WHEN may AND initial = 'a' THEN {_more('usr', 'extra', 'K', 'line')} ELSE '~' END,
                    CASE WHEN may THEN {_more('usr', '1 + extra', 'R', 'assistant_line')} ELSE '~' END
                ) AS assistant
            FROM (
                SELECT w.*, f.* EXCLUDE (conv_id, i), f.i AS i, fault IN ('', 't') AS may,
                    CASE WHEN fault = 't' THEN 5 ELSE 0 END AS extra,
                    least(nothing, system, assistant) AS before
                FROM (SELECT conv_id, i AS done, nothing, system, usr, assistant FROM ways) w
                JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.done + 1
            )
        )
    )
),
best AS (
    SELECT w.conv_id, least(nothing, assistant) AS way
    FROM ways w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(coalesce(left(way, 8), '0') AS BIGINT) AS cost,
    coalesce(way[9:strpos(way, chr(1)) - 1], '') AS audit,
    sha256(coalesce(way[strpos(way, chr(1)) + 2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
