"""Hard-negative mining with Four-Russians scoring.

Components become whole numbers. Every row is written as bit planes of its two's complement numbers: a plane has one
bit of each component, packed eight dimensions to a byte. For an anchor and a group of eight dimensions a table holds
the sums of all 256 subsets of its components. The part that a plane adds to an inner product is then a table look-up
for each byte, and the planes are added with shifts, so scores are full and exact.

Rows are cut into blocks. First every anchor meets the rows of its bucket of labels, which gives its positives, then all
rows, which gives the negatives in the score window of each positive. A unit of work is a block of anchors and a block
of rows; what leaves it is the best few rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelog.llm.common import salted_join, stored

SCALE = 256
ROWS = 8192  # rows in a block
ANCHORS = 2048  # anchors in a block
TABLES = 64  # anchors whose tables are in use at a time: half a megabyte at 64 dimensions
SLICE = 1024  # rows that are looked up at a time
REACH = 2.0**28  # scores stay below the square of this, so that a hundredfold still is a long

PACKED = "id long, label long, bits int, planes binary, numbers binary"
FOUND = "anchor long, slot int, score long, id long, row long"


def _whole(vec: list | None) -> np.ndarray | None:
    """floor(SCALE * x) of all components, or None for a vector that takes no part."""
    if vec is None or None in vec:
        return None
    x = np.array(vec, dtype=np.float64)
    with np.errstate(over="ignore"):
        x = np.floor(SCALE * x)
    if not np.isfinite(x).all() or (np.abs(x) * np.sqrt(max(1, len(x))) >= REACH).any():
        return None
    return x.astype(np.int64)


def _planes(x: np.ndarray) -> tuple[int, np.ndarray]:
    """How many bits the numbers take with their sign, and that many planes of packed bits."""
    widest = int(np.maximum(x, ~x).max(initial=0)).bit_length() + 1
    bit = (x[None, :] >> np.arange(widest)[:, None]) & 1
    return widest, np.packbits(bit.astype(np.uint8), axis=1, bitorder="little")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {name: [] for name in ("id", "label", "bits", "planes", "numbers")}
        for own, label, anchor, vec in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "anchor", "vec")), strict=True):
            x = None if own is None or label is None else _whole(vec)
            if x is None:
                continue
            bits, planes = _planes(x)
            out["id"].append(own)
            out["label"].append(label)
            out["bits"].append(bits)
            out["planes"].append(planes.tobytes())
            out["numbers"].append(x.astype("<i4").tobytes() if anchor else None)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def _matrix(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    """Rows of up to ``width`` numbers as a matrix; short rows end in zeros."""
    values = column.to_pylist()
    out = np.zeros((len(values), width), dtype=kind)
    for row, value in zip(out, values, strict=True):
        part = np.frombuffer(value, kind)
        row[: len(part)] = part
    return out


def _aligned(rows: pa.Table, groups: int) -> np.ndarray:
    """[plane, row, group]: all rows with as many planes as the widest; further planes repeat the sign."""
    bits = rows.column("bits").to_numpy()
    out = np.zeros((int(bits.max()), len(bits), groups), dtype=np.uint8)
    for at, (planes, b) in enumerate(zip(rows.column("planes").to_pylist(), bits.tolist(), strict=True)):
        own = np.frombuffer(planes, np.uint8).reshape(b, -1)
        out[:b, at, : own.shape[1]] = own
        out[b:, at, : own.shape[1]] = own[-1]
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, byte, anchor]: for each eight dimensions the sum of the components whose bits a byte has."""
    groups = -(-anchors.shape[1] // 8)
    part = np.zeros((groups * 8, len(anchors)), dtype=np.int64)
    part[: anchors.shape[1]] = anchors.T
    part = part.reshape(groups, 8, len(anchors))
    # what a plane adds up to must fit as well
    kind = np.int32 if np.abs(part).sum(axis=(0, 1)).max(initial=0) < 2**31 else np.int64
    out = np.zeros((groups, 256, len(anchors)), dtype=kind)
    for d in range(8):
        out[:, 1 << d : 2 << d] = out[:, : 1 << d] + part[:, d, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[row, anchor]: inner products by look-ups, highest plane first; that one has the sign's weight, a negative one."""
    total = np.zeros((planes.shape[1], tables.shape[2]), dtype=np.int64)
    picked = np.empty((min(SLICE, len(total)), tables.shape[2]), dtype=tables.dtype)
    for low in range(0, len(total), SLICE):
        own = total[low : low + SLICE]
        for b in range(len(planes) - 1, -1, -1):
            part = np.zeros(own.shape, dtype=tables.dtype)
            for g in range(len(tables)):
                part += np.take(tables[g], planes[b, low : low + SLICE, g], axis=0, out=picked[: len(own)], mode="clip")
            if b == len(planes) - 1:
                part = -part
            own <<= 1
            own += part
    return total


def _by_score(row: np.ndarray, score: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The order of pairs by anchor, falling score, and place."""
    return np.lexsort((place, -score, row))


def _positives(score: np.ndarray, same: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, slot, place) of the best ``k`` places of each anchor among those marked; arrays are [anchor, place]."""
    lowest = np.iinfo(np.int64).min
    masked = np.where(same, score, lowest)
    if masked.shape[1] > k:
        same = same & (masked >= np.partition(masked, -k, axis=1)[:, -k, None])
    anchor, place = np.nonzero(same)
    order = _by_score(anchor, score[anchor, place], place)
    anchor, place = anchor[order], place[order]
    rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    keep = rank < k
    return anchor[keep], np.zeros(int(keep.sum()), np.int64), place[keep]


def _negatives(
    score: np.ndarray, other: np.ndarray, marks: list[list[int]], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, slot, place): for the score of each positive the best ``k`` marked places in its window."""
    slot = np.concatenate([np.arange(len(m)) for m in marks]) if marks else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
    mark = np.array([s for m in marks for s in m], dtype=np.int64)
    low, high = -(-mark // 2), 95 * mark // 100
    floor_, top = np.full(len(marks), np.iinfo(np.int64).max), np.full(len(marks), np.iinfo(np.int64).min)
    np.minimum.at(floor_, owner, low)
    np.maximum.at(top, owner, high)
    anchor, place = np.nonzero(other & (score >= floor_[:, None]) & (score <= top[:, None]))
    found = score[anchor, place]
    order = _by_score(anchor, found, place)
    anchor, place, found = anchor[order], place[order], found[order]
    begin, end = np.searchsorted(anchor, owner), np.searchsorted(anchor, owner, side="right")
    # scores fall inside an anchor: the first one that is not above the window
    first = np.array([b + np.searchsorted(-found[b:e], -h) for b, e, h in zip(begin, end, high, strict=True)], dtype=np.int64)
    at = first[:, None] + np.arange(k)[None, :] if len(first) else np.empty((0, k), np.int64)
    fits = at < end[:, None]
    at = np.where(fits, at, 0)
    if len(found):
        fits &= found[at] >= low[:, None]
    which, _ = np.nonzero(fits)
    return owner[which], slot[which], place[at[fits]]


def _meet(k: int, positives: bool):
    """One block of rows and one block of anchors: the best rows of each anchor, or of each of its positives."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
        if rows.num_rows and anchors.num_rows:
            rows, anchors = rows.sort_by([("id", "ascending"), ("row", "ascending")]), anchors.sort_by("row")
            sizes = [pa.compute.max(pa.compute.binary_length(anchors.column("numbers"))).as_py() // 4]
            sizes.append(-(-sizes[0] // 8))
            widths = [len(p) // b for p, b in zip(rows.column("planes").to_pylist(), rows.column("bits").to_pylist(), strict=True)]
            groups = max(1, sizes[1], *widths)
            numbers = _matrix(anchors.column("numbers"), "<i4", groups * 8)
            planes = _aligned(rows, groups)
            own, ids, labels = (rows.column(c).to_numpy() for c in ("row", "id", "label"))
            whose, of = (anchors.column(c).to_numpy() for c in ("row", "label"))
            marks = None if positives else anchors.column("marks").to_pylist()
            for a in range(0, len(whose), TABLES):
                part = slice(a, a + TABLES)
                score = scores(subset_sums(numbers[part]), planes).T
                same = of[part, None] == labels[None, :]
                if positives:
                    found = _positives(score, same & (whose[part, None] != own[None, :]), k)
                else:
                    found = _negatives(score, ~same, marks[part], k)
                anchor, slot, place = found
                for values, new in zip(out, (whose[part][anchor], slot, score[anchor, place], ids[place], own[place]), strict=True):
                    values.append(new)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("anchor", "slot", "score", "id", "row")
        return pa.table({n: pa.array(np.concatenate(v), k) for n, v, k in zip(names, out, kinds, strict=True)})

    return run


def _blocks(rows: DataFrame, anchors: DataFrame, bucket: Column, k: int, positives: bool) -> DataFrame:
    """Let every block of anchors meet every block of rows of its bucket."""
    rows, anchors = rows.withColumn("bucket", bucket), anchors.withColumn("bucket", bucket)
    cut = lambda size: F.greatest(F.lit(1), F.ceil(F.count("*") / size).cast("int"))
    shape = rows.groupBy("bucket").agg(cut(ROWS).alias("blocks"))
    shape = shape.join(anchors.groupBy("bucket").agg(cut(ANCHORS).alias("groups")), "bucket")
    own = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "row"), parts).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = salted_join(rows, shape, ["bucket"], "row").withColumn("block", own(21, F.col("blocks")))
    left = left.withColumn("group", each("groups")).select("bucket", "block", "group", "row", "id", "label", "bits", "planes")
    right = salted_join(anchors, shape, ["bucket"], "row").withColumn("group", own(22, F.col("groups")))
    right = right.withColumn("block", each("blocks"))
    kept = ["bucket", "block", "group", "row", "label", "numbers", *([] if positives else ["marks"])]
    right = right.select(*kept).toDF(*kept)  # columns of its own beside those of the rows
    unit = ["bucket", "block", "group"]
    return left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_meet(k, positives), FOUND)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows marked by ``is_anchor``.

    A component x counts as floor(256 * x), and a score is an inner product with the anchor. The positives of an
    anchor are its first ``positives`` other rows of equal label, higher scores first, then smaller ids; for each of them
    the first ``negatives`` rows of other labels in that order follow, whose score is at least half and at most 0.95 of the
    positive's. ``rank`` counts them from 1; a positive without any gives no row.

    Ids and labels are whole numbers. Rows with a null id, label or vector, with a null or non-finite component, or with
    a component of 2**20 / sqrt(components) or more in size, whose scores could leave a long, take no part. Missing components
    of a shorter vector count as 0, so an empty one scores 0. Rows that repeat an id, or are equal in all columns, are rows
    of their own: each may be an anchor, a positive and a negative. An empty table gives no row. Other columns do not matter.
    """
    narrow = vectors.select(
        vectors[f"`{id_col}`"].cast("long").alias("id"),
        vectors[f"`{label_col}`"].cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        vectors[f"`{vec_col}`"].alias("vec"),
    )
    packed = stored(narrow.mapInArrow(_pack, PACKED).withColumn("row", F.monotonically_increasing_id()), "planes")
    kept = ["row", "id", "label", "numbers"]
    anchors = packed.where("numbers is not null").select(*kept).toDF(*kept)
    buckets = max(1, -(-packed.count() // ROWS))
    by_label = F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int")

    near = _blocks(packed, anchors, by_label, positives, True)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    near = near.withColumn("slot", F.row_number().over(first) - 1).where(F.col("slot") < positives)
    near = stored(near.select("anchor", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    by_slot = F.array_sort(F.collect_list(F.struct("slot", "positive_score")))  # at most ``positives``
    marks = near.groupBy("anchor").agg(F.transform(by_slot, lambda x: x["positive_score"]).alias("marks"))
    marked = anchors.join(marks.withColumnRenamed("anchor", "row"), "row")

    far = _blocks(packed, marked, F.lit(0), negatives, False)
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        far.join(near, ["anchor", "slot"])
        .join(names, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
