"""Hot, cold and merged views of one topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, with_bucket
from lakelog.functions.scalars import FIELD
from lakelog.operators import cdc
from lakelog.operators.coverage import Coverage
from lakelog.operators.frontier import Frontier
from lakelog.operators.index import OffsetIndex, Pinned, choose, predicate
from lakelog.operators.ordering import with_previous
from lakelog.sources.store import Leaf, Snapshot, Table

Source = Callable[[], DataFrame] | DataFrame | Table


def _scan(source: Source) -> DataFrame:
    """Read a tier anew, so that a query sees the rows of this moment."""
    if isinstance(source, Table):
        return source.read()
    return source() if callable(source) else source


def _folders(table: Table, snap: Snapshot, leaves: list[Leaf]) -> DataFrame:
    """The rows of some folders; all of them are the table as it is, whose files are listed already."""
    if len(leaves) == len(snap.leaves):
        return table.read(snap)
    paths = {leaf.path for leaf in leaves}
    return table.read(snap, lambda leaf: leaf.path in paths)


def archived_upto(cold: Source) -> Frontier:
    """The archive boundary, from the table's pointer if it has one."""
    if isinstance(cold, Table):
        known = cold.snapshot().frontier()
        if known is not None:
            return Frontier(known)
    return Frontier.of(_scan(cold))


def merge_tiers(hot: DataFrame | None, cold: DataFrame | None,
                boundary: Frontier | None = None) -> DataFrame:
    """All archived rows plus the hot rows beyond the boundary; no row twice.

    For frames, archived offsets have to be a prefix of each log partition: a hot
    row is new if its offset is above the partition's boundary. (A stored archive
    need not be one, see ``coverage``.) A column that one side lacks reads as null,
    and a topic with one side only is that side.
    """
    if cold is None:
        return hot
    if hot is None:
        return cold
    boundary = boundary or Frontier.of(cold)
    return _union(cold, boundary.after(hot))


def _union(cold: DataFrame, fresh: DataFrame) -> DataFrame:
    order = list(cold.columns) + [c for c in fresh.columns if c not in cold.columns]
    return cold.unionByName(fresh, allowMissingColumns=True).select(*order)


@dataclass
class Topic:
    """A named log with a live side, an archived side, or both.

    With ``key`` the hot side is a change log (operation, before, after) and the
    views show one row per key; without it rows are only ever appended. A
    ``boundary`` that is known already saves looking it up in the archive.
    """

    name: str
    hot: Source | None = None
    cold: Source | None = None
    key: str | None = None
    width: int = 1000
    boundary: Frontier | None = None

    def hot_scan(self) -> DataFrame:
        if self.key:
            return cdc.current(_scan(self.hot), self.key)
        return self._bucketed(_scan(self.hot))

    def cold_scan(self) -> DataFrame:
        """Archived rows; hidden rows of deleted keys are none."""
        if self.key and isinstance(self.cold, Table):
            return cdc.read_archive(self.cold)
        return _scan(self.cold)

    def cold_logical(self) -> DataFrame:
        """Archived rows without those whose key the live log has deleted."""
        if not self.key:
            return self.cold_scan()
        return cdc.hide_deleted(self.cold_scan(), self.deletes(), self.key)

    def deletes(self) -> DataFrame:
        return cdc.deletes(_scan(self.hot), self.key)

    def merged(self) -> DataFrame:
        if self.key:
            if self.hot is None:
                return self.cold_scan()
            if self.cold is None:
                return self.hot_scan()
            return cdc.merged(_scan(self.cold), _scan(self.hot), self.key)
        if self.hot is None:
            return self.cold_scan()
        if self.cold is None:
            return self.hot_scan()
        return _union(self._bucketed(self.cold_scan()), self._fresh())

    def _fresh(self) -> DataFrame:
        """Live rows that the archive does not hold; folders it covers are not listed."""
        if not isinstance(self.cold, Table):
            return (self.boundary or archived_upto(self.cold)).after(self.hot_scan())
        coverage = Coverage.of(self.cold)
        if not isinstance(self.hot, Table) or self.hot.snapshot().frontier() is None:
            return self._bucketed(coverage.unarchived(_scan(self.hot)))
        snap = self.hot.snapshot()
        return self._bucketed(self._rest(coverage, snap, [leaf for leaf in snap.leaves if not coverage.covers(leaf)]))

    def _rest(self, coverage: Coverage, snap: Snapshot, leaves: list[Leaf]) -> DataFrame:
        """Unarchived rows of some folders of the live log."""
        return coverage.unarchived(_folders(self.hot, snap, leaves), leaves)

    def _logs(self) -> list[tuple[Table, Snapshot]] | None:
        """Both sides with their snapshots; None if one of them is no stored log with offset folders."""
        out = []
        for side in (self.cold, self.hot):
            if side is None:
                continue
            snap = side.snapshot() if isinstance(side, Table) and not self.key else None
            if snap is None or snap.frontier() is None or any(leaf.offsets is None for leaf in snap.leaves):
                return None
            out.append((side, snap))
        return out

    def offset_sets(self) -> DataFrame | None:
        """The offsets of both sides as bitmaps, with a column ``tier``, from what their commits keep; None if they keep none."""
        sets = [
            table.offset_sets(snap).withColumn("tier", F.lit("hot" if table is self.hot else "cold"))
            for table, snap in self._logs() or []
            if snap.leaves
        ]
        return reduce(DataFrame.unionByName, sets) if sets else None

    def folders(self) -> list[tuple[int, int, int]] | None:
        """(partition, first offset, rows) of the folders of both sides, in order; None if the pointers do not say."""
        logs = self._logs()
        if logs is None:
            return None
        return sorted((leaf.values[PARTITION], leaf.low, leaf.rows) for _, snap in logs for leaf in snap.leaves)

    def newest(self, n: int) -> DataFrame:
        """The merged rows with the ``n`` highest offsets; of equal ones, of the lowest partitions."""
        return self._ends(n, True).orderBy(F.desc(OFFSET), PARTITION).limit(n)

    def oldest(self, n: int) -> DataFrame:
        return self._ends(n, False).orderBy(OFFSET, PARTITION).limit(n)

    def _ends(self, n: int, newest: bool) -> DataFrame:
        """Merged rows of the folders that can hold one of the first or last ``n``.

        The pointer knows each folder's offsets and rows, so a top-n of a stored
        topic reads a few folders at one end of the log. Live folders of which parts may
        be archived count as empty in the sum, which only makes the cut wider.
        """
        if self.key or not all(isinstance(s, Table) for s in (self.hot, self.cold)):
            return self.merged()
        hot, cold = self.hot.snapshot(), self.cold.snapshot()
        if cold.frontier() is None or hot.frontier() is None:
            return self.merged()
        coverage = Coverage.of(self.cold, cold)

        def edge(leaf: Leaf) -> int:
            return leaf.low if newest else -leaf.high

        counted = [leaf for leaf in cold.leaves] + [leaf for leaf in hot.leaves if not coverage.touches(leaf)]
        total, cut = 0, None
        for leaf in sorted(counted, key=edge, reverse=True):
            total += leaf.rows
            if total >= n:
                cut = edge(leaf)
                break

        def reaches(leaf: Leaf) -> bool:
            return cut is None or (leaf.high >= cut if newest else -leaf.low >= cut)

        live = [leaf for leaf in hot.leaves if reaches(leaf) and not coverage.covers(leaf)]
        return _union(
            self._bucketed(self.cold.read(cold, reaches)), self._bucketed(self._rest(coverage, hot, live))
        )

    def find(self, field: str, value: Any, expression: str = FIELD,
             indexes: Iterable[OffsetIndex] = ()) -> DataFrame:
        """Merged rows whose ``expression`` over ``field`` equals ``value``, by index."""
        match, best = predicate(field, value, expression), choose(indexes, field, expression)
        if best is None:
            return self.merged().where(match)
        return self.candidates(best, best.probe(expression, value)).where(match)

    def candidates(self, index: Pinned, probe: str, live: bool = True) -> DataFrame:
        """Merged rows among which all matches of a probe are: the blocks that the index
        names, commits of the archive that it has not seen, and unarchived live rows."""
        if self.cold is None:
            return index.prune(self.hot_scan(), probe)
        sides = []
        if isinstance(self.cold, Table):
            snap = self.cold.snapshot()
            top, late = snap.frontier(), index.unindexed(snap)
            rows = self._bucketed(self.cold.read(snap, (lambda leaf: leaf.commit not in late) if late else None))
            sides.append(index.prune(rows, probe, snap.props.get("width"), top and list(top)))
            if late:
                sides.append(self._bucketed(self.cold.read(snap, lambda leaf: leaf.commit in late)))
        else:
            sides.append(index.prune(self._bucketed(self.cold_scan()), probe))
        if live and self.hot is not None:
            sides.append(self._fresh())
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)

    def narrowed(self, seen: set[str], narrow: Callable[[DataFrame, Snapshot], DataFrame]) -> DataFrame:
        """Merged rows, of which those that commits in ``seen`` of a stored side hold are narrowed before tiers meet."""

        def split(rows: Callable[[list[Leaf]], DataFrame], snap: Snapshot, leaves: list[Leaf]) -> DataFrame:
            known = [leaf for leaf in leaves if leaf.commit in seen]
            rest = [leaf for leaf in leaves if leaf.commit not in seen]
            if not known:
                return rows(rest)
            sides = narrow(rows(known), snap)
            return sides.unionByName(rows(rest)) if rest else sides

        def cold_rows(leaves: list[Leaf]) -> DataFrame:
            return self._bucketed(_folders(self.cold, archived, leaves))

        def hot_rows(leaves: list[Leaf]) -> DataFrame:
            if self.cold is None:
                return self._bucketed(_folders(self.hot, live, leaves))
            return self._bucketed(self._rest(coverage, live, leaves))

        cold = fresh = archived = None
        if isinstance(self.cold, Table):
            archived = self.cold.snapshot()
            cold = split(cold_rows, archived, archived.leaves)
        elif self.cold is not None:
            cold = self._bucketed(self.cold_scan())
        if isinstance(self.hot, Table) and (archived or self.cold is None):
            live = self.hot.snapshot()
            leaves = live.leaves
            if archived:
                coverage = Coverage.of(self.cold, archived)
                leaves = [leaf for leaf in leaves if not coverage.covers(leaf)]
            fresh = split(hot_rows, live, leaves)
        elif self.hot is not None:
            fresh = self._fresh() if self.cold is not None else self.hot_scan()
        return fresh if cold is None else cold if fresh is None else _union(cold, fresh)

    def tier(self, name: str) -> DataFrame:
        return {
            "hot": self.hot_scan,
            "cold_physical": self.cold_scan,
            "cold": self.cold_logical,
            "merged": self.merged,
            "deletes": self.deletes,
        }[name]()

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df if BUCKET in df.columns else with_bucket(df, self.width)


def drop_consecutive_duplicates(
    df: DataFrame, keys: list[str], values: list[str], block: str = "hour"
) -> DataFrame:
    """Rows of a key whose ``values`` differ from the key's previous row in time.

    Rows of a key may lie in several log partitions; coordinates break ties of time.
    ``block`` is the stretch of time that one window takes at once.
    """
    tagged = with_previous(df, keys, values, time_block=block)
    same = F.col("previous").isNotNull()
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"previous.{v}"))
    return tagged.where(~same).drop("previous")
