"""Token ids of whole texts by the lower-case word vocabulary, inside Python workers.

Its pre-tokenizer never joins characters across ASCII white space, so a
text's ids are those of its space-separated chunks in a row.  Most chunks recur; their
ids are kept in a bounded table, which makes this several times faster than encoding
whole texts, with the same ids.
"""

from __future__ import annotations

import functools
import os
import sys
from array import array

from .blocks import blocks

KEPT_CHUNKS = 250_000
LONGEST_KEPT = 48
#: Punctuation that may end a chunk: a run of it after an ASCII letter is a token run of its own.
STOPS = b".,!?;:*%$#&|"
#: The vocabulary writes bytes as characters: printable ones as themselves, others from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: b if b in PRINTABLE else 256 + sum(c not in PRINTABLE for c in range(b)) for b in range(256)}
#: Below this, letters are precomposed and lower-case mappings are settled.
LATIN_END = "\u0250"


class ChunkEncoder(dict):
    """Chunk to ids, as unsigned little-endian 32-bit integers; learns what it lacks.

    Words of Latin letters go straight to the vocabulary's merges; every other chunk goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        assert array("I").itemsize == 4 and sys.byteorder == "little"
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) > KEPT_CHUNKS:
            self.clear()
        found = self._encode(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = found
        return found

    def _encode(self, chunk: bytes) -> bytes:
        low = chunk.lower()
        if low.isalpha():  # ASCII letters only
            if low != chunk:
                return self[low]
            return array("I", [t.id for t in self.merge(low.decode())]).tobytes()
        if b"<" in chunk:  # perhaps a special token's exact string
            return self._whole(chunk.decode())
        word = low.rstrip(STOPS)
        if word != low and word[-1:].isalpha():
            return self[word] + self[low[len(word) :]]
        word = low.decode()
        if word.isalpha() and max(word) < LATIN_END and len(word := word.lower()) <= LONGEST_KEPT and max(word) < LATIN_END and word.isalpha():
            spelled = word.encode().decode("latin-1").translate(BYTE_CHARS)
            return array("I", [t.id for t in self.merge(spelled)]).tobytes()
        return self._whole(chunk.decode())

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: bytes) -> bytes:
        """The ids of the whole text, block by block."""
        return b"".join([b"".join(map(self.__getitem__, block.split())) for block in blocks(text)])


@functools.cache
def encoder(path: str) -> ChunkEncoder:
    """One per Python worker and vocabulary."""
    return ChunkEncoder(path)
