"""SimHash near-dedup by anchor-point covering.

The anchors are the words of two perfect Golay codes [23, 12], laid over bits 0-22 and 23-45 of a fingerprint:
every 23 bits are within 3 of exactly one code word (the covering radius), so each fingerprint has one *home*
anchor. Fingerprints that differ in at most ``bits`` bits split that difference over the two blocks; a
fingerprint is therefore replicated to every anchor whose distances exceed 3 by no more than ``bits`` in all.
Each pair then meets at the home of either side and is compared there. For 2 bits that are about 61 copies over
2^24 anchors. Identical fingerprints are one row, so a group of copies costs nothing, and a fingerprint has at
most 2,080 others within 2 bits: links grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.llm.buffers import LOWER, SPACE, Words, pieces, text_bytes, words
from lakelog.llm.common import stored
from lakelog.llm.graph import components

LENGTH, RADIUS = 23, 3
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
CHUNK = 100_000  # shingles turned into bits at a time


# ---- fingerprints

def _shingle_hashes(found: Words, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle, and the row borders in them."""
    data = found.data
    keep = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(keep, found.starts, 1)
    np.subtract.at(keep, found.ends, 1)
    inside = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    after = found.ends[found.ends < len(data)]
    after = after[~inside[after]]  # the separator behind a word; a new row may begin there instead
    kept = inside.copy()
    kept[after] = True
    joined = data[kept]
    place = np.cumsum(kept) - 1
    joined[place[after]] = 0x20
    raw = joined.tobytes()
    counts = np.diff(found.first)
    first = np.flatnonzero(found.left() >= size)
    last = first + size - 1
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.concatenate((first, found.first[short]))
        last = np.concatenate((last, found.first[short + 1] - 1))
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]
    low, high = place[found.starts[first]].tolist(), (place[found.ends[last] - 1] + 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], seed) for a, b in zip(low, high, strict=True)), np.uint64, len(low))
    return hashes, np.searchsorted(first, found.first)


def _majority(hashes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """For each row the bits that over half of its hashes have; zero for a row without hashes."""
    counts = np.zeros((len(borders) - 1, 64), dtype=np.int64)
    rows = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    for at in range(0, len(hashes), CHUNK):
        part, own = hashes[at : at + CHUNK], rows[at : at + CHUNK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    over = counts * 2 > np.diff(borders)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprints(docs: DataFrame, text_col: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """The columns of ``docs`` but the text, with ``fp``: the 64-bit SimHash as a long."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col, 4 << 20):
                data, borders = text_bytes(piece.column(text_col))
                found = words(LOWER[data], borders, SPACE)
                fp = _majority(*_shingle_hashes(found, size, seed))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(f.name) for f in kept), pa.array(fp.view(np.int64))], [*(f.name for f in kept), "fp"]
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "fp long"])
    return docs.mapInArrow(run, schema)


# ---- anchors

@cache
def _code(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of all 23-bit values (as two tables), and error patterns by syndrome, nearest first.

    Of the patterns, each syndrome has ``upto[s, b]`` with a weight of at most RADIUS + b, from ``begin[s]`` on.
    """
    checks = LENGTH - (GENERATOR.bit_length() - 1)
    width = LENGTH - checks
    single = []
    for i in range(LENGTH):
        rest = 1 << i
        for k in range(LENGTH - 1, width - 1, -1):
            if rest >> k & 1:
                rest ^= GENERATOR << (k - width)
        single.append(rest)
    table = np.zeros(1 << 12, dtype=np.int64)
    tables = []
    for low, high in ((0, 12), (12, LENGTH)):
        table = np.zeros(1 << (high - low), dtype=np.int64)
        for i in range(low, high):
            value = np.arange(len(table))
            table ^= np.where(value >> (i - low) & 1, single[i], 0)
        tables.append(table)
    every = np.arange(1 << LENGTH, dtype=np.int64)
    weight = np.bitwise_count(every)
    near = every[weight <= RADIUS + bits]
    weight = weight[weight <= RADIUS + bits]
    syndrome = tables[0][near & 4095] ^ tables[1][near >> 12]
    order = np.lexsort((near, weight, syndrome))
    near, weight, syndrome = near[order], weight[order], syndrome[order]
    upto = np.stack([np.bincount(syndrome[weight <= RADIUS + b], minlength=1 << width) for b in range(bits + 1)], axis=1)
    begin = np.concatenate(([0], np.cumsum(upto[:, bits])[:-1]))
    excess = np.maximum(0, weight.astype(np.int64) - RADIUS)
    return (np.stack([tables[0], np.resize(tables[1], 1 << 12)]), np.stack([near, excess]), begin, upto)


def _ragged(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and running index for ``count[r]`` indices from ``begin[r]`` on."""
    rows = np.repeat(np.arange(len(begin)), count)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + begin[rows]


def anchors(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For fingerprints (uint64) the row of each copy and its anchor, the home first."""
    tables, patterns, begin, upto = _code(bits)
    low = (fp & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
    high = (fp >> np.uint64(LENGTH) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
    s1, s2 = (tables[0][x & 4095] ^ tables[1][x >> 12] for x in (low, high))
    row, i = _ragged(begin[s1], upto[s1, bits])
    again, k = _ragged(begin[s2[row]], upto[s2[row], bits - patterns[1][i]])
    row, i = row[again], i[again]
    drop = LENGTH - 12  # any 12 bits in a row name a word of a cyclic code
    return row, ((low[row] ^ patterns[0][i]) >> drop) << 12 | (high[row] ^ patterns[0][k]) >> drop


def _placed(prints: DataFrame, bits: int, home: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                fp = batch.column(0).slice(at, 10_000).to_numpy(zero_copy_only=False)
                row, anchor = anchors(fp.view(np.uint64), 0 if home else bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(fp[row])], ["anchor", "fp"])

    return prints.select("fp").mapInArrow(run, "anchor int, fp long")


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints in column ``fp`` that differ in ``bits`` bits or fewer.

    ``fp`` holds no repeats and no nulls; ``bits`` is 0 to 4 (beyond that the copies of a row are too many).
    """
    if not 0 <= bits <= 4:
        raise ValueError("bits must be 0 to 4")
    home = _placed(prints, bits, True).withColumnRenamed("fp", "a")
    visit = _placed(prints, bits, False).withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    return visit.join(home.hint("shuffle_hash"), (visit.anchor == home.anchor) & near).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bits: int = 2, seed: int = 42
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at white space; shingles of ``size`` words count as often as they
    occur, a shorter text is one shingle, and a null or empty text has fingerprint zero, linked like any other.
    ``component_id`` is the smallest id that can be reached over links. Ids are whole numbers. Rows that share an
    id are nodes of that one document. A row with a null id links nothing; it gets the component of its
    fingerprint, null if no row with an id has it. Only the id column is carried, so other names cannot clash.
    """
    narrow = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    prints = stored(fingerprints(narrow, "text", size, seed), "fingerprints")
    named = prints.where("id is not null")
    unique = stored(named.groupBy("fp").agg(F.min("id").alias("rep")), "unique-fingerprints")
    pairs = links(unique, bits)
    first = unique.select(F.col("fp").alias("a"), F.col("rep").alias("u"))
    second = unique.select(F.col("fp").alias("b"), F.col("rep").alias("v"))
    edges = pairs.join(first, "a").join(second, "b").select("u", "v")
    repeated = named.groupBy("id").agg(F.min("fp").alias("one"), F.max("fp").alias("other")).where("one <> other")
    own = named.join(repeated.select("id"), "id", "left_semi").join(unique, "fp").select(
        F.col("id").alias("u"), F.col("rep").alias("v")
    )
    roots = components(edges.unionByName(own))
    rooted = unique.join(roots, unique.rep == roots.node, "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(rooted, "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
