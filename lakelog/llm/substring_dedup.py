"""Substring dedup: word windows that also start in an earlier document, found by recompression.

Two windows with the same words have the same interior symbols. So after a few rounds of recompression each
block of documents asks, for its distinct symbols of two words or more, which ones other documents have too. A
window with an interior symbol that only one document has cannot repeat; what is left is verified: the block sends
128-bit hashes of these windows with the smallest document that holds each, and learns which start in a
smaller one. The text is dealt into blocks by one shuffle that all steps read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import SPACE, WordHash, Words, text_bytes, window_hash, words
from lakelog.llm.exchange import answers, bits, block_of, count_blocks, free_name, in_order, split, unpack
from lakelog.llm.recompression import recompress

WINDOW = 13
ROUNDS = 3
SHORTEST = 2  # words of a symbol that is asked about
SHARED, EARLIER = 0, 1  # kinds of answers
NO_ID = np.iinfo(np.int64).max
RESULT = ("n_words", "n_removed", "kept")


def _sorted_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the keys, and the places in it at which a new combination begins."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        sorted_ = key[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    return order, np.flatnonzero(new)


class Block:
    """Words, symbols and windows of one block of documents."""

    def __init__(self, rows: pa.Table, id_col: str, text_col: str, size: int, rounds: int, buckets: int):
        self.size, self.buckets = size, buckets
        self.rows = in_order(rows, id_col, text_col)
        ids = self.rows.column(id_col)
        self.ids = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy()
        self.found: Words = words(*text_bytes(self.rows.column(text_col)), SPACE)
        self.hashes = WordHash(6)(self.found)
        row = self.found.rows()
        symbols = recompress(self.hashes, row, rounds)
        fit = (symbols.end - symbols.start >= SHORTEST) & (symbols.high - symbols.low < size)
        fit &= self.ids[symbols.row] != NO_ID
        symbols = symbols.take(np.flatnonzero(fit))
        self.low, self.high = symbols.low, symbols.high
        self.names, self.name_at = np.unique(symbols.name, return_inverse=True)
        self.row = row
        self.symbol_row = symbols.row

    def ask_shared(self, block: int) -> pa.Table:
        """Distinct symbols, and which of them two documents of the block have."""
        least = np.full(len(self.names), NO_ID)
        most = np.full(len(self.names), np.iinfo(np.int64).min)
        ids = self.ids[self.symbol_row]
        np.minimum.at(least, self.name_at, ids)
        np.maximum.at(most, self.name_at, ids)
        filled, borders = split(self.names, self.buckets)
        cut = [slice(borders[b], borders[b + 1]) for b in filled]
        return pa.table(
            {
                "bucket": pa.array(filled, pa.int32()),
                "block": pa.array(np.full(len(filled), block), pa.int32()),
                "keys": pa.array([self.names[c].tobytes() for c in cut], pa.binary()),
                "rest": pa.array([bits((least != most)[c]) for c in cut], pa.binary()),
            }
        )

    def candidates(self, told: pa.Table) -> None:
        """Windows without an interior symbol that no other document has; their distinct keys, sorted."""
        _, borders = split(self.names, self.buckets)
        shared = answers(told, SHARED, borders, len(self.names))[self.name_at]
        low, high = self.low[~shared], self.high[~shared]
        first, last = np.maximum(high - self.size + 1, 0), low
        fine = (low >= 0) & (first <= last)
        edges = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(edges, first[fine], 1)
        np.subtract.at(edges, last[fine] + 1, 1)
        possible = (np.cumsum(edges[:-1]) == 0) & (self.found.left() >= self.size)
        if len(self.row):
            possible &= self.ids[self.row] != NO_ID
        self.at = np.flatnonzero(possible)
        one = window_hash(self.hashes, self.size)[self.at]
        two = window_hash(WordHash(13)(self.found), self.size, 0xC2B2AE3D27D4EB4F)[self.at]
        doc = self.ids[self.row[self.at]]
        order, heads = _sorted_groups(one, two)
        self.key_one, self.key_two = one[order[heads]], two[order[heads]]
        self.least = np.minimum.reduceat(doc[order], heads) if len(heads) else doc
        self.key_at = np.empty(len(order), dtype=np.int64)
        self.key_at[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))

    def ask_earlier(self, block: int) -> pa.Table:
        filled, borders = split(self.key_one, self.buckets)
        cut = [slice(borders[b], borders[b + 1]) for b in filled]
        return pa.table(
            {
                "bucket": pa.array(filled, pa.int32()),
                "block": pa.array(np.full(len(filled), block), pa.int32()),
                "keys": pa.array(
                    [np.concatenate((self.key_one[c], self.key_two[c])).tobytes() for c in cut], pa.binary()
                ),
                "rest": pa.array([self.least[c].tobytes() for c in cut], pa.binary()),
            }
        )

    def removed(self, told: pa.Table) -> np.ndarray:
        """Words covered by a window that starts in a smaller document, of this block or another."""
        _, borders = split(self.key_one, self.buckets)
        earlier = answers(told, EARLIER, borders, len(self.key_one))
        hit = (earlier | False)[self.key_at] | (self.least[self.key_at] < self.ids[self.row[self.at]])
        edges = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(edges, self.at[hit], 1)
        np.subtract.at(edges, self.at[hit] + self.size, 1)
        return np.cumsum(edges[:-1]) > 0

    def kept_text(self, gone: np.ndarray) -> pa.Array:
        """The words that stay, joined by one space."""
        at = np.flatnonzero(~gone)
        row = self.row[at]
        length = self.found.ends[at] - self.found.starts[at]
        gap = np.zeros(len(at), dtype=np.int64)
        gap[:-1] = row[1:] == row[:-1]
        ends = np.cumsum(length + gap)
        index = np.repeat(self.found.starts[at] - (ends - length - gap), length + gap) + np.arange(ends[-1] if len(at) else 0)
        out = self.found.data[np.minimum(index, max(0, len(self.found.data) - 1))]
        out[(ends - 1)[gap == 1]] = 0x20
        borders = np.concatenate(([0], ends))[np.searchsorted(row, np.arange(len(self.ids) + 1))]
        return pa.LargeStringArray.from_buffers(
            len(self.ids), pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(out)
        ).cast(pa.string())


ASKED = "bucket int, block int, keys binary, rest binary"
TOLD = "block int, bucket int, kind int, answer binary"


def _told(rows: pa.Table, kind: int, mask: np.ndarray, borders: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "block": rows.column("block"),
            "bucket": rows.column("bucket"),
            "kind": pa.array(np.full(rows.num_rows, kind), pa.int32()),
            "answer": pa.array([bits(mask[a:b]) for a, b in zip(borders[:-1], borders[1:], strict=True)], pa.binary()),
        }
    )


def _shared(rows: pa.Table) -> pa.Table:
    """Which keys of each block two blocks hold, or two documents of one block."""
    keys, borders = unpack(rows.column("keys"), "<u8")
    many = np.concatenate(
        [
            np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n).astype(bool)
            for x, n in zip(rows.column("rest"), np.diff(borders), strict=True)
        ]
    )
    order, heads = _sorted_groups(keys)
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    twice = (np.diff(np.append(heads, len(order))) > 1) | np.logical_or.reduceat(many[order], heads)
    mask = np.empty(len(keys), dtype=bool)
    mask[order] = twice[group]
    return _told(rows, SHARED, mask, borders)


def _earlier(rows: pa.Table) -> pa.Table:
    """Which windows of each block start in a smaller document of another block."""
    both, edges = unpack(rows.column("keys"), "<u8")
    halves = [both[a:b].reshape(2, -1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    one, two = (np.concatenate([h[k] for h in halves]) for k in (0, 1))
    least, borders = unpack(rows.column("rest"), "<i8")
    order, heads = _sorted_groups(one, two)
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    mask = np.empty(len(one), dtype=bool)
    mask[order] = np.minimum.reduceat(least[order], heads)[group] < least[order]
    return _told(rows, EARLIER, mask, borders)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, rounds: int = ROUNDS
) -> DataFrame:
    """Columns of ``docs`` but the text, with ``n_words``, ``n_removed`` and ``kept`` (words joined by a space).

    Words are separated by white space and compared unchanged. Each word goes that a window of ``size`` words
    covers whose words also start in a document with a smaller id; windows are judged on the input. Ids are whole
    numbers. Null and empty texts have no words and become the empty text. Rows that share an id are one document
    and do not remove each other's words. A row with a null id keeps its words and removes nothing. Columns of
    ``docs`` with the names of results are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text_col, *RESULT)]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`"))
    key = free_name(docs, "block")
    blocks = count_blocks(docs, text_col)
    buckets = max(1, blocks // 3)
    dealt = docs.withColumn(key, block_of(docs, id_col, text_col, blocks))
    by_block = dealt.groupBy(key)

    def open_(rows: pa.Table) -> tuple[Block, int]:
        return Block(rows, id_col, text_col, size, rounds, buckets), rows.column(key)[0].as_py()

    def first(rows: pa.Table) -> pa.Table:
        block, number = open_(rows)
        return block.ask_shared(number)

    def second(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.schema(
                [("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("rest", pa.binary())]
            ).empty_table()
        block, number = open_(rows)
        block.candidates(told)
        return block.ask_earlier(number)

    def third(rows: pa.Table, told: pa.Table) -> pa.Table:
        block, _ = open_(rows)
        block.candidates(told)
        gone = block.removed(told)
        counts = np.concatenate(([0], np.cumsum(gone)))[block.found.first]
        return pa.Table.from_arrays(
            [
                *(block.rows.column(f.name) for f in kept),
                pa.array(np.diff(block.found.first), pa.int64()),
                pa.array(np.diff(counts), pa.int64()),
                block.kept_text(gone),
            ],
            [*(f.name for f in kept), *RESULT],
        )

    shared = by_block.applyInArrow(first, ASKED).groupBy("bucket").applyInArrow(_shared, TOLD)
    earlier = (
        by_block.cogroup(shared.groupBy("block")).applyInArrow(second, ASKED).groupBy("bucket").applyInArrow(_earlier, TOLD)
    )
    schema = T.StructType(
        [
            *kept,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    return by_block.cogroup(shared.unionByName(earlier).groupBy("block")).applyInArrow(third, schema)
