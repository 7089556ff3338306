"""Connected components by alternating large-star and small-star rounds, all in DataFrames.

A node with a third of all links sends one row per task to the minimum, and its join is an ordinary one that
AQE splits; no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.llm.common import stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: the links as stars around the smallest node of each local component."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top:
                parent[x], x = top, up
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["u", "v"]
        )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v in each edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: root is the smallest node it can reach.

    ``links`` has two columns of whole numbers; direction, repeats and links of a node to itself do not matter,
    and a link with a null end is none.
    """
    a, b = links.columns
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    links = links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    links = links.where(F.col("u") > F.col("v"))
    edges = stored(links.mapInArrow(_forest, "u long, v long").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
