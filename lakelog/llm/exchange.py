"""Questions about 64-bit keys that blocks of rows put to buckets of keys, and the answers.

Rows are dealt into blocks of a few megabytes of text. A block sends each bucket one row with all its distinct
keys of that bucket, sorted, as packed bytes; the bucket sends back one row with the answers in the same order,
one bit or number for each key. A block can work its keys out again from its rows, so the keys never travel back.
A key that a third of all rows hold is one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4 << 20  # bytes of text


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores as long as ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def count_blocks(docs: DataFrame, text_col: str, size: int = BLOCK) -> int:
    """How many blocks of about ``size`` bytes the texts make, with at most a few thousand rows in each."""
    total, rows = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`"))), F.count("*")).first()
    return max(1, -(-(total or 0) // size), -(-rows // 20_000))


def block_of(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> Column:
    """A block by id and text, so that many rows with one id, or none, are spread as well."""
    return F.pmod(F.xxhash64(docs[f"`{id_col}`"], docs[f"`{text_col}`"]), F.lit(blocks)).cast("int")


def in_order(rows: pa.Table, id_col: str, text_col: str) -> pa.Table:
    """The rows of a block in an order that does not depend on how they arrived."""
    return rows.sort_by([(id_col, "ascending"), (text_col, "ascending")]).combine_chunks()


def split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys the bucket borders: bucket b holds keys[borders[b]:borders[b + 1]].

    Buckets are ranges of the high bits, so sorting by key sorts by bucket.
    """
    width = (2**64 + buckets - 1) // buckets
    edges = np.array([b * width for b in range(1, buckets)], dtype=np.uint64)
    borders = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
    return np.flatnonzero(np.diff(borders)), borders


def unpack(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column as one array, and the row borders in it."""
    parts = [np.frombuffer(x.as_buffer(), dtype=kind) for x in column]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def answers(rows: pa.Table, kind: int, borders: np.ndarray, total: int) -> np.ndarray:
    """The answer bits of one kind for all ``total`` keys of a block; ``borders`` as given by ``split``."""
    out = np.zeros(total, dtype=bool)
    if total:
        own = rows.filter(pa.compute.equal(rows.column("kind"), kind))
        for b, mask in zip(own.column("bucket").to_pylist(), own.column("answer").to_pylist(), strict=True):
            low, high = borders[b], borders[b + 1]
            out[low:high] = np.unpackbits(np.frombuffer(mask, np.uint8), count=high - low).astype(bool)
    return out
