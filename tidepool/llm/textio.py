"""Small helpers for Arrow batches of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: The white space of all word and line rules here: space and \t \n \v \f \r.
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def word_pieces(data: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """Words of a text in order, a list per piece of about ``size`` bytes.

    A word never spans two pieces, so a text of any length needs memory for
    one piece of words only.
    """
    start = 0
    while start < len(data) or start == 0:
        stop = start + size
        if stop < len(data):
            gap = SPACE.search(data, stop)
            stop = gap.start() if gap else len(data)
        yield data[start:stop].split()
        start = max(stop, 1)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that few texts are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
