"""Words of Arrow text columns as numpy arrays: where they start and end, whose they are, and 64-bit hashes of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
EMPTY = np.zeros(0, np.int64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over all bytes that is true inside the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# words are runs of anything but space and the controls 9 to 13; every byte of a longer UTF-8 character is 0x80 or more
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# words are runs of ASCII digits, ASCII letters and all characters from 0x80 on
LETTERED = ~byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1B54A32D192ED03))


_TABLES: dict[int, np.ndarray] = {}
KEPT = 1 << 22


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64, from a table that grows to ``KEPT`` entries."""
    table = _TABLES.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(1 << 12, 1 << max(n - 1, 1).bit_length()), base, np.uint64)
        steps[:1] = 1
        table = np.cumprod(steps, dtype=np.uint64)
        if len(table) <= KEPT:
            _TABLES[base] = table
    return table[:n]


def byte_hashes(data: np.ndarray) -> np.ndarray:
    """Running hash before each byte and after the last: differences give the hash of any stretch (see ``stretch_hashes``)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def stretch_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches [start, end), equal for equal bytes wherever they stand."""
    inverse = powers(INVERSE, len(running))
    return mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a run of rows, in order of their place."""

    rows: int
    row: np.ndarray  # row of each word
    starts: np.ndarray  # byte where it starts, in the block
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # index of the first word of each row, and the number of words at the end
    data: np.ndarray
    row_starts: np.ndarray  # byte where each row starts, and the number of bytes at the end


def text_blocks(column: pa.Array, limit: int = 1 << 20):
    """Runs of rows of about ``limit`` bytes (one row at least): (first row, bytes, offsets of the rows and the end).

    Nulls count as empty.  Arrays derived from a block are a small multiple of its bytes, whatever the batch holds.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, content = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    content = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, content[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def split_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = True) -> Words:
    """The words of a block; ``kind`` says which bytes belong to words.  Words never cross rows."""
    n = len(offsets) - 1
    if lower:
        data = LOWER[data]
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    return Words(n, row, starts, ends, stretch_hashes(byte_hashes(data), starts, ends), first, data, offsets)


def text_words(column: pa.Array, kind: np.ndarray, lower: bool = True, limit: int = 1 << 20):
    """(first row, words) of each block of a text column."""
    for at, data, offsets in text_blocks(column, limit):
        yield at, split_words(data, offsets, kind, lower)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, U(width))
    for k in range(width):
        out = out * U(BASE) + hashes[k : k + n]
    return mix(out)
