"""Edit-aware token counts: a segment tree of pre-token counts per document.

A document is cut into pre-token chunks; leaves hold a run of chunks with its text and its number of
tokens, inner nodes the sums of characters and tokens below them. An edit finds its leaf by
character sums, chunks the touched leaves anew together with the context before them that a cut may
depend on, and goes on only until a cut falls on a leaf border again. Cuts depend on what follows,
never on what went before, so from there on all chunks are the old ones. Only the changed leaves are
re-encoded and the sums above them updated.

Defined results: a null text counts as empty and has no tokens; a null or empty list of edits changes
nothing. Edits name places in the text as given (start, end exclusive, replacement), must not
overlap and may come in any order; edits near each other are made as one; null edits and null replacements are taken as none and as
deletions. Repeated rows are counted each. Extra columns are left alone.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.tokens import CHUNK, default_vocabulary, encoder

LEAF = 8  # chunks
NEAR = 32  # characters between edits that are made as one
EDITS = "array<struct<start:int,end:int,replacement:string>>"
LOOK_BACK = 2  # characters before an edit that a cut may have looked past


class TokenTree:
    """Token counts of one text under edits."""

    def __init__(self, chunks: list[str], counts: list[int], count_chunks):
        self.count_chunks = count_chunks
        self.reencoded = 0
        n = max(1, -(-len(chunks) // LEAF))
        self.size = 1 << (n - 1).bit_length()
        self.leaves = ["".join(chunks[LEAF * k:LEAF * (k + 1)]) for k in range(self.size)]
        self.tokens, self.chars = [0] * (2 * self.size), [0] * (2 * self.size)
        for k in range(n):
            self.tokens[self.size + k] = sum(counts[LEAF * k:LEAF * (k + 1)])
            self.chars[self.size + k] = len(self.leaves[k])
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds the character at ``place``."""
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if place - first >= self.chars[node] and self.chars[node + 1]:
                first += self.chars[node]
                node += 1
        return node - self.size, first

    def _store(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.size
        self.chars[node], self.tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from ``start`` to ``end`` (exclusive)."""
        leaf, first = self._leaf_at(max(0, start - LOOK_BACK))
        last, covered = leaf, first + len(self.leaves[leaf])
        while covered < end:
            last += 1
            covered += len(self.leaves[last])
        old = "".join(self.leaves[leaf:last + 1])
        text = old[:start - first] + replacement + old[end - first:]
        while True:
            # What follows decides the last cut: take the next leaf in as context.
            nxt = last + 1
            while nxt < self.size and not self.leaves[nxt]:
                nxt += 1
            after = self.leaves[nxt] if nxt < self.size else ""
            chunks, at, met = [], 0, not after
            for m in CHUNK.finditer(text + after):
                if m.end() > len(text):
                    break
                chunks.append(m[0])
                at = m.end()
            if met or at == len(text):
                break
            text, last = text + after, nxt
        self.reencoded += len(chunks)
        for k in range(leaf + 1, last + 1):
            if self.leaves[k]:
                self._store(k, "", 0)
        self._store(leaf, text, sum(self.count_chunks(chunks)))

    def text(self) -> str:
        return "".join(self.leaves)


def together(text: str, edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits that lie ``NEAR`` each other as one, from the last to the first."""
    out: list[list] = []
    for start, end, new in sorted(edits, key=lambda e: e[:2]):
        if out and start - out[-1][1] <= NEAR:
            out[-1][2] += [text[out[-1][1]:start], new]
            out[-1][1] = end
        else:
            out.append([start, end, [new]])
    return [(a, b, "".join(parts)) for a, b, parts in reversed(out)]


def masks(pattern: str, replacement: str):
    """A maker of edits that put ``replacement`` in place of every match of ``pattern``."""
    compiled = re.compile(pattern)
    return lambda text: [(m.start(), m.end(), replacement) for m in compiled.finditer(text)]


def count(docs: DataFrame, make_edits=None, vocabulary: str | None = None) -> DataFrame:
    """Counts before and after the edits of ``docs(doc_id, text, edits)``.

    ``edits`` is an array of (start, end, replacement); ``make_edits``, a function from a text to a
    list of such triples, may take the place of the column. Returns doc_id, n_chunks, n_tokens,
    n_edits, n_tokens_after and n_reencoded, the chunks that the edits made it encode again.
    """
    path = vocabulary or default_vocabulary()
    frame = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.lit(None) if make_edits else F.col("edits")).cast(EDITS).alias("edits"),
    )
    names = ["n_chunks", "n_tokens", "n_edits", "n_tokens_after", "n_reencoded"]

    def run(batches):
        found = encoder(path, plain=True)

        def count_chunks(chunks):
            return [len(ids) // 4 for ids in found.encode_chunks(chunks)]

        for batch in batches:
            rows = []
            for text, edits in zip(batch.column(1), batch.column(2)):
                chunks = CHUNK.findall(text.as_py())
                tree = TokenTree(chunks, count_chunks(chunks), count_chunks)
                before = tree.total
                if make_edits:
                    edits = make_edits(text.as_py())
                else:
                    edits = [
                        (e["start"], e["end"], e["replacement"] or "")
                        for e in edits.as_py() or () if e is not None
                    ]
                for start, end, new in together(text.as_py(), edits):
                    tree.edit(start, end, new)
                rows.append((len(chunks), before, len(edits), tree.total, tree.reencoded))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), pa.int64()) for c in columns)],
                ["doc_id", *names],
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))


def op9_token_counts(spark, sf_dir):
    """Counts of every document, and of its version with numbers and runs of symbols masked."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count(docs, masks("[0-9]+|[#*$%&|<>]{2,}", "0"))
