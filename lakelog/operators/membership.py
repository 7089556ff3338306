"""Virtual topics whose membership is maintained: which offsets of a stored topic satisfy a predicate.

Members are bitmaps of offsets, a commit of them for each refresh, built before the shuffle from the commits of both
tiers that were not seen before. The pointer keeps the ranges of offsets in which all members lie, so a reader goes
straight to the folders and row groups of these ranges without a job of its own. Commits that came since are read
in full; the predicate is applied to all rows again, so what is delivered is right at any time.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelog.functions import bitmaps
from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, any_of, range_text
from lakelog.operators.index import require_stable
from lakelog.operators.replay import VirtualTopic
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Snapshot, Table

# Ranges of a pointer: beyond that the nearest ones are joined, which reads more and loses nothing. A condition of twice
# as many is too large a method for the JVM to compile, and each row pays for it.
MOST_RANGES = 32
LEAST_GAP = 20_000  # offsets between two ranges: about a page of a Parquet file, less lets a scan pass over nothing


class Membership:
    """The members of a virtual topic among the rows of the stored tiers of a topic."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = Table(spark, path)

    @staticmethod
    def build(spark: SparkSession, path: str, topic: Topic, where: str) -> Membership:
        """Take in all rows that the stored tiers of ``topic`` have now; ``where`` is SQL text over their columns.

        A side that is no stored table is never taken in: its rows are filtered by each reader. Topics that are change
        logs have no rows that stay, and are refused.
        """
        require_stable(where, "a virtual topic")
        if topic.key:
            raise ValueError("rows of a change log do not stay; a virtual topic needs a log that is only appended")
        kept = Membership(spark, path)
        empty = spark.createDataFrame([], f"{PARTITION} int, {bitmaps.SLOT} bigint, {bitmaps.BITMAP} binary, low bigint, high bigint")
        kept.table.create(empty, props={"where": where, "commits": [], "ranges": [], "loose": False})
        kept.refresh(topic)
        return kept

    @property
    def where(self) -> str:
        return self.table.snapshot().props["where"]

    def refresh(self, topic: Topic) -> int:
        """Take in the commits that were not seen yet, and return how many. Only their rows are read.

        Members that are gone from the log stay in the bitmaps, which costs a range at most: an offset is not used again.
        """
        base = self.table.snapshot()
        seen, late = set(base.props["commits"]), set()
        live: set[str] = set()
        fresh: list[DataFrame] = []
        loose = base.props["loose"]
        for side in (topic.cold, topic.hot):
            if not isinstance(side, Table):
                continue
            snap = side.snapshot()
            own = {leaf.commit for leaf in snap.leaves}
            live |= own
            if not own - seen:
                continue
            late |= own - seen
            rows = side.read(snap, lambda leaf: leaf.commit not in seen).where(base.props["where"])
            # Row groups that lack no offset are passed over by their statistics.
            loose = loose or not rows.where(f"{OFFSET} IS NULL OR {PARTITION} IS NULL").isEmpty()
            fresh.append(bitmaps.build(rows).select(PARTITION, bitmaps.SLOT, bitmaps.BITMAP, "low", "high"))
        if not late:
            return 0
        base = self.table.append(reduce(DataFrame.unionByName, fresh), base=base)
        # Commits are told after their bitmaps: a refresh that breaks off between takes them in again.
        self.table.set_props(
            commits=sorted((seen & live) | late), ranges=_ranges(self.table.read(base), MOST_RANGES), loose=loose
        )
        return len(late)

    def members(self) -> int:
        """Offsets taken in so far, counted from the bitmaps."""
        total = bitmaps.unite(self.table.read()).agg(F.sum(F.bitmap_count(bitmaps.BITMAP))).first()[0]
        return total or 0

    def read(self, topic: Topic) -> DataFrame:
        """The merged rows of ``topic`` that satisfy the predicate, whether they were taken in or not."""
        props = self.table.snapshot().props

        def narrow(rows: DataFrame, snap: Snapshot) -> DataFrame:
            found = None if props["loose"] else _inside(props["ranges"], snap.props.get("width") if BUCKET in rows.columns else None)
            return rows if found is None else rows.where(found)

        return topic.narrowed(set(props["commits"]), narrow).where(props["where"])

    def virtual(self, name: str, topic: Topic) -> VirtualTopic:
        """The virtual topic, for paged and resumed reading."""
        return VirtualTopic(name, lambda: self.read(topic))


def _ranges(sets: DataFrame, most: int) -> list[list[int]] | None:
    """At most ``most`` ranges (partition, low, high) in which all offsets of the sets are; None if there are more partitions.

    The widest gaps between members of neighbouring slots part the ranges. They are found by a top-k over all partitions.
    """
    slots = sets.groupBy(PARTITION, bitmaps.SLOT).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    bounds = slots.groupBy(PARTITION).agg(F.min("low").alias("low"), F.max("high").alias("high")).limit(most + 1).collect()
    if len(bounds) > most:
        return None
    before = F.lag("high").over(Window.partitionBy(PARTITION).orderBy("low"))
    gaps = slots.select(PARTITION, (before + 1).alias("gap_start"), (F.col("low") - 1).alias("gap_end"))
    gaps = gaps.where(F.col("gap_end") - F.col("gap_start") >= LEAST_GAP)
    widest = gaps.orderBy(F.desc(F.col("gap_end") - F.col("gap_start")), PARTITION, "gap_start").limit(most - len(bounds))
    parted: dict[int, list[tuple[int, int]]] = {}
    for r in widest.collect():
        parted.setdefault(r[PARTITION], []).append((r["gap_start"], r["gap_end"]))
    out = []
    for r in sorted(bounds, key=lambda r: r[PARTITION]):
        low = r["low"]
        for start, end in sorted(parted.get(r[PARTITION], [])):
            out.append([r[PARTITION], low, start - 1])
            low = end + 1
        out.append([r[PARTITION], low, r["high"]])
    return out


def _inside(ranges: list[list[int]] | None, width: Any) -> str | None:
    """SQL text of the ranges; None if there are none to tell."""
    if ranges is None:
        return None
    hit = any_of(range_text(low, high + 1, p, width) for p, low, high in ranges)
    # Offsets alone once more: what mixes folder columns in does not reach the row groups.
    joined: list[list[int]] = []
    for low, high in sorted((low, high) for _, low, high in ranges):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    return f"{hit} AND {any_of(range_text(low, high + 1) for low, high in joined)}"
