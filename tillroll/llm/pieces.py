"""SentencePiece ids and texts through a table of distinct marked words.

The library writes every space as a marker and puts one marker before the text. Where no piece of the
vocabulary goes from a character to a marker after it, no merge can cross the place between them: a
text falls into marked words (a run of markers with the characters up to the next marker), and each
is segmented alone, whatever stands around it. A task numbers the marked words of a batch of texts,
segments each distinct one that its table does not hold yet in one call of the library, and joins the
ids back by position. The table is bounded: it starts anew after ``REMEMBERED`` words, and words
longer than ``LONGEST`` characters are segmented for their batch only, so memory follows the largest
text and not the corpus. Decoding takes the same way: the table also holds what the library makes of
a word's ids. Nothing is shuffled, so a document or a word that fills a third of the corpus costs its
own length and no more, and a lost task repeats its own texts only.

A vocabulary with a piece across a marker, or with a normaliser that rewrites texts, is refused.

Defined results: a null text counts as empty, an empty text has no ids. Repeated rows and null ids are
rows of their own. Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import id_and_text

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")  # every marked text is a row of these
REMEMBERED = 300_000
LONGEST = 64
TOGETHER = 1 << 20  # characters of text that are looked up together


class WordTable:
    """Segmentations of marked words under one vocabulary. One per Python worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        self._refuse_crossing_pieces()
        self.single = self.library.piece_to_id(MARK)
        # Decoded after this piece, a word keeps the space that stands at the start of a text only.
        self.before = self.library.encode("a")
        self.held: dict[str, tuple[tuple[int, ...], str, str]] = {}
        self.passing: list[str] = []  # long words of the last batch

    def _refuse_crossing_pieces(self) -> None:
        size = self.library.get_piece_size()
        crossing = [p for p in map(self.library.id_to_piece, range(size))
                    if re.search(f"[^{MARK}]{MARK}", p)]
        probe = "a  Ａ  é\t b "
        if crossing or self.library.decode(self.library.encode(probe)) != probe:
            raise ValueError(f"pieces cross markers or texts are rewritten: {crossing[:3]}")

    def _segment(self, words: list[str]) -> list[tuple[tuple[int, ...], str, str]]:
        """(ids, ids in decimal, decoded text) of each word; the library puts the first marker back."""
        found = self.library.encode([w[1:] for w in words], num_threads=1)
        found = [ids if w != MARK else [self.single] for w, ids in zip(words, found)]
        skip = len(self.library.decode(self.before))
        texts = self.library.decode([self.before + ids for ids in found], num_threads=1)
        return [
            (tuple(ids), ",".join(map(str, ids)), text[skip:]) for ids, text in zip(found, texts)
        ]

    def look_up(self, words: set[str]) -> dict[str, tuple[tuple[int, ...], str, str]]:
        """The table, with a row for each of a batch of distinct words until the next batch."""
        if len(self.held) > REMEMBERED:
            self.held.clear()
        for word in self.passing:
            self.held.pop(word, None)
        new = sorted(words.difference(self.held))
        if new:
            self.held.update(zip(new, self._segment(new)))
        self.passing = [w for w in new if len(w) > LONGEST]
        return self.held


def marked_words(text: str) -> list[str]:
    """The marked words of a text in order; joined they are the text as the library marks it."""
    return WORD.findall(MARK + text.replace(" ", MARK)) if text else []


_TABLES: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    """The worker's table of that vocabulary file."""
    from tillroll.llm import pieces as home  # one table per worker, not one per shipped copy

    found = home._TABLES.get(path)
    if found is None:
        found = home._TABLES[path] = WordTable(path)
    return found


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _each_text(docs: DataFrame, vocabulary: str | None, id_column: str, text_column: str,
               fields: str, row) -> DataFrame:
    """``row(rows of the table in the text's order)`` for every text, as columns ``fields``."""
    texts = id_and_text(docs, id_column, text_column)
    path = vocabulary or default_vocabulary()
    names = ["doc_id", *(f.split()[0] for f in fields.split(", "))]
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    kinds = [types[f.split()[1]] for f in fields.split(", ")]

    def run(batches):
        table = word_table(path)
        for batch in batches:
            owners, column, at = batch.column(0), batch.column(1), 0
            while at < len(column):
                first, cut, held = at, [], 0
                while at < len(column) and held < TOGETHER:
                    text = column[at].as_py()
                    cut.append(marked_words(text))
                    held += len(text)
                    at += 1
                known = table.look_up(set().union(*cut))
                rows = [row([known[w] for w in words]) for words in cut]
                yield pa.RecordBatch.from_arrays(
                    [owners.slice(first, at - first),
                     *(pa.array(list(c), t) for c, t in zip(zip(*rows), kinds))], names
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, {fields}")


def _decoded(found: list[tuple[tuple[int, ...], str, str]]) -> str:
    """Words' texts joined; the space of the first marker is dropped as the library drops it."""
    return "".join([word[2] for word in found])[1:]


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every whole text and the text that they decode to."""
    def row(found):
        return [i for word in found for i in word[0]], _decoded(found)

    return _each_text(docs, vocabulary, id_column, text_column, "ids array<int>, decoded string", row)


def decode_documents(
    encoded: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id",
    ids_column: str = "ids",
) -> DataFrame:
    """(doc_id, decoded) of any id sequences, those of this module or not; null ids count as none."""
    path = vocabulary or default_vocabulary()
    source = encoded.selectExpr(f"`{id_column}` AS doc_id", f"cast(`{ids_column}` AS array<int>) AS ids")

    def run(batches):
        library = word_table(path).library
        for batch in batches:
            texts = [library.decode([i for i in ids or [] if i is not None])
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, decoded string")


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) without the ids leaving the task."""
    def row(found):
        ids = ",".join([word[1] for word in found])
        return (
            sum([len(word[0]) for word in found]),
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(_decoded(found).encode()).hexdigest(),
        )

    return _each_text(
        docs, vocabulary, "doc_id", "text",
        "n_tokens long, ids_sha256 string, decoded_sha256 string", row,
    )


def op13_sentencepiece(spark, sf_dir):
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
