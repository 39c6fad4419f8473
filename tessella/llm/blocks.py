"""Walking over long texts in bounded pieces, inside Python workers."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: A space after a visible ASCII character: nothing that tokenizers or words join spans it.
#: The spaces are those that bytes.split() splits at: space, and tab to carriage return.
SPACE = re.compile(rb"(?<=[!-~])[ \t-\r]")
BLOCK = 1 << 20


def blocks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``text`` in slices of about ``size`` bytes, cut where a space begins."""
    if len(text) <= size:
        yield text
        return
    at = 0
    while at < len(text):
        space = SPACE.search(text, min(at + size, len(text)))
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def texts(column) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow string column, one by one; null as empty."""
    import pyarrow as pa

    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""
