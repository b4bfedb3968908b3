"""Words, hashes and windows over blocks of UTF-8 texts, as numpy arrays.

Python tasks of this subpackage read texts as Arrow binary columns. ``blocks`` cuts a
record batch into runs of rows of some megabytes, so that temporary arrays stay small
however long the batch is; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21

# The six ASCII white-space bytes.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

with np.errstate(over="ignore"):

    def mix(x: np.ndarray) -> np.ndarray:
        """A bijective scrambling of 64-bit words (splitmix64)."""
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x1000003))


_BYTE = randoms(256, 1)
_PLACE = randoms(1 << 12, 2) | np.uint64(1)
_TURN = randoms(64, 3) | np.uint64(1)


@dataclass
class Block:
    """Texts ``first`` to ``first + n`` of a batch: their bytes and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def binary(column: pa.Array) -> pa.Array:
    """A text or binary column as large binary without nulls (a null is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Runs of rows of about ``most`` bytes; a longer text is a block of its own."""
    column = binary(column)
    if not len(column):
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first : last + 1]
        yield Block(first, values[part[0] : part[-1]], part - part[0])
        first = last


@dataclass
class Words:
    """Byte spans of the words of a block, and the row (in the block) of each."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def words(block: Block, inside: np.ndarray) -> Words:
    """Maximal runs of bytes in ``inside`` (a table of 256), cut where a text ends."""
    size = len(block.data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    held = inside[block.data]
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    heads = block.offsets[:-1]
    heads = heads[heads < size]
    begins[heads] = held[heads]
    ends = held.copy()
    ends[:-1] &= ~held[1:]
    tails = block.offsets[1:] - 1
    tails = tails[tails >= 0]
    ends[tails] = held[tails]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(block.offsets, start, "right") - 1
    return Words(start, end, row)


def counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a sum of random numbers by byte and by place."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    before = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64)
    at = place + np.repeat(start - before, length)
    place -= np.repeat(before, length)
    longest = int(length.max())
    turn = _PLACE if longest <= len(_PLACE) else randoms(longest, 2) | np.uint64(1)
    return mix(np.add.reduceat(_BYTE[data[at]] * turn[place], before) + length.astype(np.uint64))


def windows(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words inside one row, and the first word of each."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(m, np.uint64)
    for i in range(k):
        turn = _TURN[i] if i < len(_TURN) else randoms(i + 1, 3)[i] | np.uint64(1)
        total += hashes[i : m + i] * turn
    first = np.flatnonzero(row[:m] == row[k - 1 :])
    return mix(total[first]), first
