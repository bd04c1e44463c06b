"""Token ids of whole texts, with a bounded memory of the chunks seen before.

The byte-level tokenizer first cuts a text into pieces, and its cuts never cross from one run of
non-spaces to the next: a run, with the one plain space before it, is encoded on its own. Natural
text repeats such chunks, so their ids are looked up instead of encoded again.
"""

from __future__ import annotations

import os
import re

import numpy as np

# White space as the tokenizer knows it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
REMEMBERED = 1_500_000  # chunks (about 200 MB), then the memory starts anew
LONGEST = 40  # longer chunks are encoded, not remembered
TOGETHER = 4096  # new chunks that are encoded in one call


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers. One per Python worker.

    The tokenizer's special strings give their own ids where they stand in a text, as the library has
    it by default; with ``plain`` they are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A special string parts the text for the tokenizer, so such a text is encoded whole.
        self.parting = re.compile("|".join(map(re.escape, added))) if added and not plain else None
        self.seen: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)  # a byte-level token has a character per byte

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks. Those that begin with a space stay apart when laid end to end."""
        found, spaced = {}, []
        for c in chunks:
            if c[0] == " " and c[-1] != " ":
                spaced.append(c)
            else:
                found[c] = self._ids(c).tobytes()
        for at in range(0, len(spaced), TOGETHER):
            some = spaced[at:at + TOGETHER]
            joined = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, dtype="<u4")
            ends = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in some])
            cuts = (np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1) * 4
            flat, begin = ids.tobytes(), 0
            for c, end in zip(some, cuts.tolist()):
                found[c] = flat[begin:end]
                begin = end
        return found

    def encode_all(self, texts: list[str]) -> list[list[bytes]]:
        """Per text, the ids of its chunks."""
        parting = self.parting
        whole = {k for k, t in enumerate(texts) if parting.search(t)} if parting else ()
        cut = [() if k in whole else CHUNK.findall(t) for k, t in enumerate(texts)]
        seen = self.seen
        out = [list(map(seen.get, chunks)) for chunks in cut]
        open_texts = [k for k, found in enumerate(out) if None in found]
        if open_texts:
            new = {c for k in open_texts for c, ids in zip(cut[k], out[k]) if ids is None}
            fresh = self._encode_chunks(sorted(new))
            for k in open_texts:
                out[k] = [fresh[c] if ids is None else ids for c, ids in zip(cut[k], out[k])]
            if len(seen) + len(fresh) > REMEMBERED:
                seen.clear()
            seen.update((c, ids) for c, ids in fresh.items() if len(c) <= LONGEST)
        for k in whole:
            out[k] = [self._ids(texts[k]).tobytes()]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of these chunks."""
        fresh = self._encode_chunks(sorted(set(chunks).difference(self.seen)))
        out = [fresh[c] if c in fresh else self.seen[c] for c in chunks]
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        self.seen.update((c, ids) for c, ids in fresh.items() if len(c) <= LONGEST)
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.encode_all([text])[0])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder of that vocabulary file."""
    from tillroll.llm import tokens as home  # one table per worker, not one per shipped copy

    found = home._ENCODERS.get((path, plain))
    if found is None:
        found = home._ENCODERS[path, plain] = Encoder(path, plain)
    return found


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
