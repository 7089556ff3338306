"""Benchmark decontamination: a broadcast hash set of benchmark word windows, scanned over all documents.

The set is broadcast in slices of a bounded number of windows. A benchmark that fits one slice takes one scan of
the documents; a larger one takes one scan for each slice, so that no broadcast grows with it. Candidates by hash
are verified by comparing the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import LOWER, NOT_ALNUM, WordHash, Words, cover, pieces, text_bytes, window_hash, words
from lakelog.llm.common import stored

WINDOW = 10
SLICE = 200_000  # windows in one broadcast, about 100 bytes each
RESULT = ("n_words", "n_hit", "hits", "items")


def _words(column: pa.Array) -> tuple[Words, np.ndarray]:
    """Words of the lower-cased texts, and the row borders."""
    data, borders = text_bytes(column)
    return words(LOWER[data], borders, NOT_ALNUM), borders


def _phrase(found: Words, at: int, size: int) -> bytes:
    return b" ".join(
        found.data[a:b].tobytes() for a, b in zip(found.starts[at : at + size], found.ends[at : at + size], strict=True)
    )


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """One row for each distinct window of each item: (item, size, phrase)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, _ = _words(piece.column("text"))
                item, length, phrase = [], [], []
                for r, name in enumerate(piece.column("item").to_pylist()):
                    low, high = found.first[r], found.first[r + 1]
                    k = int(min(size, high - low))
                    for at in range(low, high - k + 1) if k else ():
                        item.append(name)
                        length.append(k)
                        phrase.append(_phrase(found, at, k).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.string()), pa.array(length, pa.int32()), pa.array(phrase, pa.string())],
                    ["item", "size", "phrase"],
                )

    narrow = benchmark.select(
        benchmark[f"`{id_col}`"].cast("string").alias("item"), benchmark[f"`{text_col}`"].alias("text")
    )
    return narrow.mapInArrow(cut, "item string, size int, phrase string").distinct()


@dataclass
class WindowSet:
    """Windows of one slice: for each size the sorted hashes, and the words and items behind each hash."""

    sizes: dict[int, np.ndarray] = field(default_factory=dict)
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[bytes, list[str]] = field(default_factory=dict)

    @staticmethod
    def of(rows: pa.Table) -> WindowSet:
        out = WindowSet()
        for item, size, phrase in zip(*(rows.column(c).to_pylist() for c in ("item", "size", "phrase")), strict=True):
            names = out.items.setdefault(phrase.encode(), [])
            out.sizes.setdefault(size, [])
            if item is not None:
                names.append(item)
        hashing = WordHash(SEED)
        by_size: dict[int, list[bytes]] = {}
        for phrase in out.items:
            by_size.setdefault(phrase.count(b" ") + 1, []).append(phrase)
        for size, phrases in by_size.items():
            found, _ = _words(pa.array([p.decode() for p in phrases], pa.large_string()))
            out.sizes[size] = hashes = np.unique(window_hash(hashing(found), size)[found.first[:-1]])
            out.filters[size] = np.zeros(1 << FILTER_BITS, dtype=bool)
            out.filters[size][hashes >> np.uint64(64 - FILTER_BITS)] = True
        return out


SEED = 8
FILTER_BITS = 20


def _scan(found: Words, hashing: WordHash, windows: WindowSet) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """Words that benchmark windows cover, and (row, phrase) of each verified hit."""
    names = hashing(found)
    hit = np.zeros(len(found), dtype=bool)
    verified: list[tuple[int, bytes]] = []
    left = found.left()
    rows = found.rows()
    for size, known in windows.sizes.items():
        hashes = window_hash(names, size)
        maybe = np.flatnonzero(windows.filters[size][hashes >> np.uint64(64 - FILTER_BITS)])
        maybe = maybe[left[maybe] >= size]
        maybe = maybe[known[np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)] == hashes[maybe]]
        sure = []
        for at in maybe:
            phrase = _phrase(found, at, size)
            if phrase in windows.items:
                sure.append(at)
                verified.append((int(rows[at]), phrase))
        if sure:
            hit |= cover(np.array(sure), size, len(found))
    return hit, verified


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    slice_size: int = SLICE,
    keep_text: bool = True,
) -> DataFrame:
    """Columns of ``docs`` with ``n_words``, ``n_hit``, ``hits`` (one bit a word) and ``items`` (sorted ids).

    A window is ``size`` consecutive words of an item, or all words of a shorter item; a word inside any
    occurrence is hit. Null and empty texts have no words. Rows are judged one by one, so repeated ids do not
    matter. An item without an id hits but is not listed. Without items nothing is hit. Columns of ``docs``
    with the names of results are replaced; ``keep_text=False`` leaves the text out of the result.
    """
    spark = docs.sparkSession
    windows = item_windows(benchmark, item_id, item_text, size)
    slices = max(1, -(-windows.count() // slice_size))
    held = docs.drop(*RESULT)
    state = held.select("*", F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("array<string>").alias("items"))
    for k in range(slices):
        rows = windows.where(F.pmod(F.xxhash64("phrase"), F.lit(slices)) == k) if slices > 1 else windows
        shared = spark.sparkContext.broadcast(WindowSet.of(rows.toArrow()))
        last = k == slices - 1
        state = _pass(state, shared, text_col, keep_text or not last)
        if not last:  # one set in memory at a time; the next scan drops what this one counted
            state = stored(state.drop("n_words", "n_hit"), "windows")
    return state


def _pass(docs: DataFrame, shared, text_col: str, keep_text: bool) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in RESULT and (keep_text or f.name != text_col)]
    schema = T.StructType(
        [
            *kept,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("hits", T.BinaryType()),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, windows = WordHash(SEED), shared.value
        for batch in batches:
            for piece in pieces(batch, text_col):
                found, _ = _words(piece.column(text_col))
                hit, verified = _scan(found, hashing, windows)
                names = [set(x or ()) for x in piece.column("items").to_pylist()]
                for r, phrase in verified:
                    names[r].update(windows.items[phrase])
                before = piece.column("hits").to_pylist()
                masks, counts = [], []
                for r, (low, high) in enumerate(zip(found.first[:-1], found.first[1:], strict=True)):
                    own = hit[low:high]
                    if before[r] is not None:
                        own = own | np.unpackbits(np.frombuffer(before[r], np.uint8), count=high - low).astype(bool)
                    counts.append(int(own.sum()))
                    masks.append(np.packbits(own).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(f.name) for f in kept),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(masks, pa.binary()),
                        pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                    ],
                    [f.name for f in schema],
                )

    return docs.mapInArrow(scan, schema)


def remove_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The result of ``find_windows`` with the hit words, and what stands between them, cut out of the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = text_bytes(batch.column(text_col))
            place = words(LOWER[data], borders, NOT_ALNUM)
            texts = batch.column(text_col).to_pylist()
            for r, mask in enumerate(batch.column("hits").to_pylist()):
                low, high = place.first[r], place.first[r + 1]
                hit = np.unpackbits(np.frombuffer(mask, np.uint8), count=high - low).astype(np.int8)
                if not hit.any():
                    continue
                edges = np.diff(np.concatenate(([0], hit, [0])))
                raw, out, at = data[borders[r] : borders[r + 1]].tobytes(), [], 0
                for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
                    out.append(raw[at : place.starts[low + a] - borders[r]])
                    at = place.ends[low + b - 1] - borders[r]
                texts[r] = b"".join([*out, raw[at:]]).decode()
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, text_col, pa.array(texts, pa.string()))

    return found.mapInArrow(cut, found.schema)
