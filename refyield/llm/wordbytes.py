"""Words of UTF-8 texts in bytes: runs of digits, ASCII letters and all characters
beyond ASCII, with A-Z in lower case and nothing else changed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Every byte that belongs to no word becomes a blank, A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

#: The same words in DuckDB.
WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, a null text as none."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def runs_of(texts: list[bytes], size: int, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """(start, stop) of consecutive texts, at most ``most`` of them and ``size``
    bytes together; one longer text stands alone."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and (held + len(t) > size or i - start >= most):
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """Translated bytes in pieces of about ``size``, cut where a blank is."""
    start = 0
    while len(text) - start > size:
        stop = text.rfind(b" ", start, start + size)
        if stop <= start:
            stop = text.find(b" ", start + size)
            if stop < 0:
                break
        yield text[start:stop]
        start = stop
    yield text[start:]


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in translated bytes."""
    inside = np.concatenate([[False], text != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]
