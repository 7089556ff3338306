"""Words and word windows of Arrow string columns, as numpy arrays over the bytes of the column.

A *word* is a run of bytes that are not separators, inside one row. Rows that are null hold no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes hashed at a time


def separators(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags that is true for the bytes of the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# fixed values: white space, and everything in ASCII but digits and lower-case letters
SPACE = separators([(0x20, 0x20), (0x09, 0x0D)])
NOT_ALNUM = separators([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row borders in them (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(offsets):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of some rows: byte positions in ``data`` and the range of words of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # row r holds the words first[r] up to first[r + 1]

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """For each word, how many words its row has from there on."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def words(data: np.ndarray, borders: np.ndarray, separator: np.ndarray) -> Words:
    """Find the words of rows that lie one after the other in ``data``."""
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(borders), np.int64))
    return marked(data, borders, ~separator[data])


def marked(data: np.ndarray, borders: np.ndarray, inside: np.ndarray) -> Words:
    """The runs of marked bytes of rows that lie one after the other in ``data``, which is not empty."""
    filled = borders[:-1][np.diff(borders) > 0]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[filled] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[filled[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, borders))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a name look random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash:
    """64-bit polynomial hashes of words, from prefix sums over the bytes; the seed picks the family."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.value = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(2**40, 2**60)) * 8 + 5
        self.back = pow(self.base, -1, 2**64)
        self.power = self.inverse = np.empty(0, np.uint64)
        self.grow(1024)

    def grow(self, size: int) -> None:
        """Make the tables reach over ``size`` bytes."""
        if size <= len(self.power):
            return
        with np.errstate(over="ignore"):
            for name, factor in (("power", self.base), ("inverse", self.back)):
                table = np.full(size, np.uint64(factor))
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def __call__(self, found: Words) -> np.ndarray:
        out = np.empty(len(found), dtype=np.uint64)
        at = 0
        while at < len(found):
            begin = found.starts[at]
            to = max(at + 1, int(np.searchsorted(found.ends, begin + CHUNK, side="right")))
            part = found.data[begin : found.ends[to - 1]]
            self.grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(self.value[part] * self.power[: len(part)], out=sums[1:])
            low, high = found.starts[at:to] - begin, found.ends[at:to] - begin
            out[at:to] = (sums[high] - sums[low]) * self.inverse[low]
            at = to
        return mix(out)


def window_hash(values: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each ``size`` consecutive values; the caller drops windows that leave their row."""
    count = max(0, len(values) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    factor = np.uint64(base)
    for k in range(size):
        out *= factor
        out += values[k : k + count]
    return mix(out)


def starts_of_windows(found: Words, size: int) -> np.ndarray:
    """Word positions at which ``size`` words of one row begin."""
    return np.flatnonzero(found.left() >= size)


def cover(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.subtract.at(edges, starts + size, 1)
    return np.cumsum(edges[:-1]) > 0


def pieces(batch: pa.RecordBatch | pa.Table, column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each piece holds about ``size`` bytes of text, one row at least."""
    if isinstance(batch, pa.Table):
        for part in batch.to_batches():
            yield from pieces(part, column, size)
        return
    if not batch.num_rows:
        return
    _, borders = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(borders, borders[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
