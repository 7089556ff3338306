"""Embedding near-dedup: an exact metric range join over pivots.

Only vectors with equal labels are compared. Equal vectors are one class first. About one vector in CELL becomes a
pivot of its label, and each vector has its home in the cell of the nearest pivot. Angles obey the triangle
inequality: a vector whose home is p can have a partner at home in q only if its angle to q exceeds that to p by no
more than twice the threshold angle; the half-space between p and q, seen from the vector, bounds this more
closely still. Such vectors also visit q, if q comes before p, so each pair meets in exactly one cell. Cells of more than
BLOCK members are compared block by block. Counts and spanning links leave a block, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.common import salted_join, stored
from lakelog.llm.graph import components

CELL = 4096  # vectors for each pivot
PIVOTS = 512  # about the most pivots of a label
CHUNK = 8192  # vectors that are assigned to cells at a time
BLOCK = 4096  # members that are compared with as many others at a time: 134 MB of cosines
STRIPE = 256  # rows of a link matrix that are searched at a time


def _packed(vectors: DataFrame) -> DataFrame:
    """(id, label, dim, vec): the components as bytes, null for a vector that links with nothing."""
    kind = vectors.schema["vec"].dataType.elementType
    form = "<f4" if isinstance(kind, T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for own, label, vec in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vec")), strict=True):
                x = None
                if own is not None and label is not None and vec and None not in vec:
                    x = np.array(vec, dtype=form)
                    wide = x.astype(np.float64)
                    if not np.isfinite(wide).all() or not wide.any():
                        x = None
                out.append(None if x is None else x.tobytes())
                dims.append(0 if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                ["id", "label", "dim", "vec"],
            )

    return vectors.mapInArrow(run, "id long, label string, dim int, vec binary")


def _form(vectors: DataFrame, vec_col: str) -> str:
    return "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"


def _unit(column: pa.ChunkedArray, form: str) -> np.ndarray:
    """Vectors of length one, in double precision."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=form).astype(np.float64).reshape(len(column), -1)
    raw /= np.abs(raw).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


PLACED = "label string, dim int, cell int, home boolean, node long, copies long, vec binary"


def _assign(angle: float, form: str):
    """Homes and visits of a chunk of vectors among the pivots of their label."""

    def run(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = pivots.sort_by("node")
        x, p = _unit(rows.column("vec"), form), _unit(pivots.column("vec"), form)
        # A cosine is right to about the number of components times the rounding unit. Angles and chords of vectors that
        # nearly agree are wrong by up to the root of that, so the bounds give way by more.
        slack = 4 * np.sqrt(x.shape[1] * np.finfo(np.float64).eps)
        close = x @ p.T
        turn = np.arccos(np.clip(close, -1, 1))
        home = close.argmax(axis=1)
        at = np.arange(len(x))
        near = turn <= (turn[at, home] + 2 * angle + slack)[:, None]
        gap = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[home]  # from the home pivot to each other one
        near &= close[at, home][:, None] - close <= np.sin(min(angle, np.pi / 2)) * gap + slack
        near &= np.arange(len(p))[None, :] < home[:, None]
        near[at, home] = True
        row, cell = np.nonzero(near)
        picked = rows.take(pa.array(row))
        return pa.table(
            {
                "label": picked.column("label"),
                "dim": picked.column("dim"),
                "cell": pa.array(cell, pa.int32()),
                "home": pa.array(cell == home[row]),
                "node": picked.column("node"),
                "copies": picked.column("copies"),
                "vec": picked.column("vec"),
            }
        )

    return run


def _roots(linked: np.ndarray, ids: list[np.ndarray], own: bool) -> np.ndarray:
    """For the rows and then the columns of a link matrix the smallest id of their component."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    some = linked[np.ix_(rows, columns)]
    place = [rows, columns if own else columns + len(ids[0])]  # a block with itself has each vector once
    label = np.arange(len(ids[0]) + len(ids[1]))

    def least(links: np.ndarray, of: np.ndarray) -> np.ndarray:
        parts = [np.where(links[k : k + STRIPE], of, len(label)).min(axis=1) for k in range(0, len(links), STRIPE)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    while len(rows):
        before = label.copy()
        label[place[0]] = np.minimum(label[place[0]], least(some, label[place[1]]))
        label[place[1]] = np.minimum(label[place[1]], least(some.T, label[place[0]]))
        label = label[label]
        if (before == label).all():
            break
    all_ids = np.concatenate(ids)
    smallest = np.full(len(label), np.iinfo(np.int64).max)
    np.minimum.at(smallest, label, all_ids)
    return smallest[label]


def _compare(threshold: float, form: str):
    """Links between two blocks of a cell: how many each vector has, and a spanning forest."""

    def run(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        left, right = (rows.filter(pa.array(side == s)) for s in (0, 1))
        own = rows.column("low")[0] == rows.column("high")[0]  # a block with itself
        right = left if own else right
        ids = [t.column("node").to_numpy() for t in (left, right)]
        home = [t.column("home").to_numpy(zero_copy_only=False) for t in (left, right)]
        copies = [t.column("copies").to_numpy() for t in (left, right)]
        if not left.num_rows or not right.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        linked = _unit(left.column("vec"), form) @ _unit(right.column("vec"), form).T >= threshold
        linked &= home[0][:, None] | home[1][None, :]
        if own:
            np.fill_diagonal(linked, False)
        counts = [linked @ copies[1], copies[0] @ linked]
        if own:
            counts[1] = np.zeros_like(counts[1])
        roots = _roots(linked, ids, own)
        all_ids, all_counts = np.concatenate(ids), np.concatenate(counts)
        some = np.flatnonzero(all_counts)
        return pa.table(
            {
                "node": pa.array(all_ids[some], pa.int64()),
                "links": pa.array(all_counts[some], pa.int64()),
                "root": pa.array(roots[some], pa.int64()),
            }
        )

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    cell: int = CELL,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Rows with equal labels and as many components link if their cosine, in double precision, is at least
    ``threshold`` (above 0). ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    that links reach, and a row is kept if that is its own. Ids are whole numbers; a null id, a null label, and a
    vector that is null, empty, zero or holds null or non-finite components link with nothing. Rows that repeat an id are
    vectors of their own under that name.
    """
    form, angle = _form(vectors, vec_col), float(np.arccos(threshold))
    rows = _packed(
        vectors.select(
            vectors[f"`{id_col}`"].cast("long").alias("id"),
            vectors[f"`{label_col}`"].cast("string").alias("label"),
            vectors[f"`{vec_col}`"].alias("vec"),
        )
    )
    # A vector is told by 128 bits of its components where only its class is looked up.
    rows = rows.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(7), "vec"))
    valid = rows.where("vec is not null")
    group, same_vec = ["label", "dim"], ["label", "dim", "h1", "h2"]
    classes = valid.groupBy(*same_vec, "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    order = F.pmod(F.xxhash64(F.lit(10), "node"), F.lit(1 << 40))
    sizes = classes.groupBy(*group).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    sized = salted_join(classes, sizes, group, "node")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    wanted = F.least(F.ceil(F.col("n") / cell), F.lit(PIVOTS))
    pivot = (order == F.col("first")) | (order / F.lit(float(1 << 40)) < (wanted - 1) / F.col("n"))
    pivots = sized.where(pivot).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    by = [*group, "chunk"]
    pivots = pivots.select(*by, "node", "vec").toDF(*by, "node", "vec")  # columns of its own beside those of the vectors
    chunked = sized.withColumn("chunk", F.pmod(F.xxhash64(F.lit(11), "node"), chunks).cast("int"))
    chunked = chunked.select(*by, "node", "copies", "vec")
    placed = stored(
        chunked.groupBy(*by).cogroup(pivots.groupBy(*by)).applyInArrow(_assign(angle, form), PLACED), "cells"
    )

    place = [*group, "cell"]
    blocks = placed.groupBy(*place).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own_block = F.pmod(F.xxhash64(F.lit(12), "node"), "blocks").cast("int")
    cut = salted_join(placed, blocks, place, "node").withColumn("own", own_block)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = cut.select(
        *place, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "home", "node", "copies", "vec",
    )
    found = stored(
        units.groupBy(*place, "low", "high").applyInArrow(_compare(threshold, form), "node long, links long, root long"),
        "embedding-links",
    )
    several = valid.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    again = valid.select("id", *same_vec).join(several, "id", "left_semi")
    named = salted_join(again, classes.select(*same_vec, "node"), same_vec, "id").select("id", "node")
    same_id = named.join(named.groupBy("id").agg(F.min("node").alias("root")).toDF("id", "root"), "id").select("node", "root")
    roots = components(found.select("node", "root").unionByName(same_id)).toDF("node", "root")
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component")).toDF("root", "component")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = rooted.join(smallest, "root").join(counted, "node", "left").select(
        *same_vec, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"
    )
    named = salted_join(rows.select("id", *same_vec), known, same_vec, "id", "left")
    component = F.coalesce("component", "id")
    return named.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
