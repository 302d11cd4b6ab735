"""Words of whole Arrow text columns as numpy arrays: positions and 64-bit hashes, without a Python object per word.

A word is a run of characters other than space and \\x09-\\x0D. All of these are single bytes in UTF-8, so words are
found on the bytes. Null and empty texts have no words. Long texts are handled in blocks, so memory follows the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BLOCK_BYTES = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass
class Block:
    """Consecutive texts of one column. `bounds` are the byte offsets of the texts within `data`."""

    first: int
    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def word_bounds(self) -> np.ndarray:
        """Of each text, the first of its words; one more at the end."""
        return np.searchsorted(self.start, self.bounds)

    def texts(self) -> Iterator[tuple[int, int, int]]:
        """Row in the column, first word and end of words, for each text."""
        bounds = self.word_bounds
        for i in range(len(self.bounds) - 1):
            yield self.first + i, int(bounds[i]), int(bounds[i + 1])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows. Null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in runs of whole texts of about `block_bytes`."""
    data, at = text_bytes(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(at, at[row] + block_bytes, "right")) - 1)
        part, bounds = data[at[row] : at[to]], at[row : to + 1] - at[row]
        start, end = word_spans(part, bounds)
        yield Block(row, part, bounds, start, end)
        row = to


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words; no word crosses a bound."""
    inside = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result looks random in every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(block: Block, lower: bool = False, most: int = 100_000) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z as a-z if `lower`; of at most `most` words at a time."""
    out = np.empty(len(block.start), np.uint64)
    at = 0
    while at < len(out):
        # Sums over a run of bytes, of which a word's hash is a difference, so long as the powers reach.
        low = int(block.start[at])
        to = max(at + 1, min(at + most, int(np.searchsorted(block.end, low + RUN, "right"))))
        letters = block.data[low : int(block.end[to - 1])]
        if lower:
            letters = LOWER[letters]
        powers, inverse = (POWERS, INVERSE) if len(letters) <= RUN else _powers(len(letters))
        sums = np.zeros(len(letters) + 1, np.uint64)
        terms = letters.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers[: len(letters)]
        np.cumsum(terms, out=sums[1:])
        start, end = block.start[at:to] - low, block.end[at:to] - low
        out[at:to] = mix((sums[end] - sums[start]) * inverse[start])
        at = to
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor from the first on, and of its inverse modulo 2 ** 64 from the zeroth on."""
    powers = np.cumprod(np.full(n, _FACTOR, np.uint64))
    inverse = np.full(n, pow(int(_FACTOR), -1, 1 << 64), np.uint64)
    inverse[:1] = 1
    return powers, np.cumprod(inverse)


RUN, LONG_RUN = 1 << 15, 16
POWERS, INVERSE = _powers(RUN)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` consecutive words of one text."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    if size > LONG_RUN:
        # Differences of sums over stretches of words.
        for at in range(0, len(out), RUN - size):
            some = hashes[at : at + RUN - 1]
            sums = np.zeros(len(some) + 1, np.uint64)
            np.cumsum(some * INVERSE[: len(some)], out=sums[1:])
            n = min(len(some) - size + 1, RUN - size)
            out[at : at + n] = (sums[size : size + n] - sums[:n]) * POWERS[size - 2 : size - 2 + n]
        return mix(out)
    for k in range(size):
        out = out * _FACTOR + hashes[k : len(hashes) - size + 1 + k]
    return mix(out)
