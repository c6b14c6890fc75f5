"""Words and their hashes in whole Arrow batches, as numpy arrays.

Texts are UTF-8 bytes laid end to end.  A word is a maximal run of word bytes
inside one text; its hash is a polynomial over a fixed random table of bytes,
modulo 2**64.  Callers that report a match compare the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true outside the given inclusive ranges."""
    out = np.ones(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = False
    return out


#: All bytes but the space and tab to carriage return.
SPACED = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Digits, letters and all bytes of non-ASCII characters.
ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: ASCII capitals to small letters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of the base."""
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 256), _BASE, dtype=np.uint64)
            steps[0] = 1
            _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


@dataclass
class Words:
    """``data`` (lower case), and for each word its text's number in the block, bounds in ``data`` and hash; ``first`` has each text's first word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()

    def text_of(self, k: np.ndarray) -> np.ndarray:
        """The number of the text of each word."""
        return np.searchsorted(self.first, k, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True) -> Words:
    data = LOWER[data] if lower else data
    inside = table[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, offsets, starts, ends, first, np.zeros(0, dtype=np.uint64))
    at = np.flatnonzero(inside)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    with np.errstate(over="ignore"):
        hashes = np.add.reduceat(_BYTE[data[at]] * powers(int(lengths.max()))[place], heads)
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
    return Words(data, offsets, starts, ends, first, hashes)


def word_hash(word: bytes) -> int:
    data = np.frombuffer(word, dtype=np.uint8)
    return int(words(data, np.array([0, len(data)]), np.ones(256, dtype=bool), lower=False).hashes[0])


def blocks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of about ``size`` bytes; a longer text is a run of its own.  Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, raw[offsets[row] : offsets[last]], (offsets[row : last + 1] - offsets[row]).astype(np.int64)
        row = last
