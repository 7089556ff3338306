"""Which rows of a live log an archive holds: the one definition that merge, append and trim share.

The pointer of an archive lists the lowest and highest offset and the number of distinct offsets of every folder. A
folder that has as many as lie between its bounds is *complete*: each of them is archived. Other folders may have gaps, so
rows of the live log that fall among them are looked up in the bitmaps of offsets that each commit has. Nothing is taken for archived only
because it lies below the highest archived offset.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.functions import bitmaps
from lakelog.functions.coords import OFFSET, PARTITION, any_of
from lakelog.sources.store import Leaf, Snapshot, Table

LITERAL_SPANS = 256  # more spans than this are not written into a predicate

Spans = dict[int, list[tuple[int, int]]]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive spans in order, with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _text(spans: Spans) -> str:
    return any_of(
        f"{PARTITION} = {p} AND {OFFSET} BETWEEN {low} AND {high}" for p, own in sorted(spans.items()) for low, high in own
    )


@dataclass
class Coverage:
    """Complete spans, and the folders that may have gaps (all of the table if it has no offset folders)."""

    table: Table
    snap: Snapshot
    complete: Spans = field(default_factory=dict)
    loose: list[Leaf] = field(default_factory=list)

    @staticmethod
    def of(table: Table, snap: Snapshot | None = None) -> Coverage:
        snap = snap or table.snapshot()
        whole: Spans = {}
        loose = []
        for leaf in snap.leaves:
            if leaf.low is not None and leaf.offsets == leaf.high - leaf.low + 1:
                whole.setdefault(leaf.values[PARTITION], []).append((leaf.low, leaf.high))
            else:
                loose.append(leaf)
        return Coverage(table, snap, {p: _joined(own) for p, own in whole.items()}, loose)

    def text(self) -> str:
        """The complete spans as SQL; empty if there are none, or too many for a predicate."""
        count = sum(map(len, self.complete.values()))
        return _text(self.complete) if 0 < count <= LITERAL_SPANS else ""

    def covers(self, leaf: Leaf) -> bool:
        """Whether every offset of a folder of the live log is archived."""
        if leaf.low is None:
            return False
        own = self.complete.get(leaf.values[PARTITION], [])
        return any(low <= leaf.low and leaf.high <= high for low, high in own)

    def touches(self, leaf: Leaf) -> bool:
        """Whether a folder of the live log may hold an archived row."""
        if leaf.low is None:
            return bool(self.snap.leaves)
        p = leaf.values[PARTITION]
        if any(low <= leaf.high and leaf.low <= high for low, high in self.complete.get(p, [])):
            return True
        return any(
            x.low is None or x.values[PARTITION] == p and x.low <= leaf.high and leaf.low <= x.high for x in self.loose
        )

    def unarchived(self, hot: DataFrame, among: list[Leaf] | None = None) -> DataFrame:
        """Rows of ``hot`` that the archive does not hold; ``among`` are the folders that ``hot`` consists of."""
        if not self.snap.leaves:
            return hot
        doubtful, rows = self.loose, hot
        if text := self.text():
            rows = rows.where(f"NOT ({text})")
        elif self.complete:
            doubtful = self.snap.leaves
        if any(leaf.low is None for leaf in doubtful):  # no bounds in the pointer: all coordinates are looked up
            return bitmaps.outside(rows, self.table.offset_sets(self.snap))
        reach = _reach(hot, among) if doubtful else {}
        near = {
            leaf.path: leaf
            for leaf in doubtful
            if (at := reach.get(leaf.values[PARTITION])) and leaf.low <= at[1] and at[0] <= leaf.high
        }
        if not near:
            return rows
        spans: Spans = {}
        for leaf in near.values():
            spans.setdefault(leaf.values[PARTITION], []).append((leaf.low, leaf.high))
        spans = {p: _joined(own) for p, own in spans.items()}
        if sum(map(len, spans.values())) > LITERAL_SPANS:
            spans = {p: [(own[0][0], own[-1][1])] for p, own in spans.items()}
        have = self.table.offset_sets(self.snap, lambda leaf: leaf.path in near)
        if len(spans) > LITERAL_SPANS:
            return bitmaps.outside(rows, have)
        inside = _text(spans)
        return rows.where(f"NOT ({inside})").unionByName(bitmaps.outside(rows.where(inside), have))


def _reach(hot: DataFrame, among: list[Leaf] | None) -> dict[int, tuple[int, int]]:
    """Lowest and highest offset of each log partition, from the pointer or by one aggregation."""
    if among is None or any(leaf.low is None for leaf in among):
        tops = hot.groupBy(PARTITION).agg(F.min(OFFSET).alias("low"), F.max(OFFSET).alias("high"))
        return {r[PARTITION]: (r["low"], r["high"]) for r in tops.collect()}
    out: dict[int, tuple[int, int]] = {}
    for leaf in among:
        low, high = out.get(leaf.values[PARTITION], (leaf.low, leaf.high))
        out[leaf.values[PARTITION]] = min(low, leaf.low), max(high, leaf.high)
    return out
