"""A Parquet table that is written in full first and published by one pointer swap.

Every commit writes one new ``commit=...`` folder with Spark's own Parquet
writer. The pointer then lists the leaf folders that make up the table, so an
append or a rewrite of a few folders leaves all others untouched, and a reader
sees either the old or the new list.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.functions import bitmaps
from lakelog.functions.coords import PARTITION
from lakelog.functions.scalars import sql_literal
from lakelog.sources.files import Files, Pointer


@dataclass
class Leaf:
    """One leaf folder: its partition values and, for logs, its offset bounds."""

    path: str
    values: dict[str, int] = field(default_factory=dict)
    low: int | None = None
    high: int | None = None
    rows: int | None = None
    offsets: int | None = None  # distinct ones; unknown in pointers written without

    @property
    def commit(self) -> str:
        return self.path.split("/", 1)[0]


@dataclass
class Snapshot:
    version: int = 0
    schema: T.StructType | None = None
    partition_by: list[str] = field(default_factory=list)
    leaves: list[Leaf] = field(default_factory=list)
    columns: dict[str, list[str]] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    props: dict[str, Any] = field(default_factory=dict)

    def document(self) -> dict[str, Any]:
        return {
            "schema": self.schema.jsonValue(),
            "partition_by": self.partition_by,
            "leaves": [vars(leaf) for leaf in self.leaves],
            "columns": self.columns,
            "sizes": self.sizes,
            "applied": self.applied,
            "props": self.props,
        }

    @staticmethod
    def of(version: int, doc: dict[str, Any]) -> Snapshot:
        if not doc:
            return Snapshot()
        return Snapshot(
            version,
            T.StructType.fromJson(doc["schema"]),
            list(doc["partition_by"]),
            [Leaf(**leaf) for leaf in doc["leaves"]],
            dict(doc["columns"]),
            dict(doc["sizes"]),
            dict(doc["applied"]),
            dict(doc["props"]),
        )

    def frontier(self) -> dict[int, int] | None:
        """Highest archived offset per log partition, read from the pointer alone."""
        if PARTITION not in self.partition_by:
            return None
        top: dict[int, int] = {}
        for leaf in self.leaves:
            p = leaf.values[PARTITION]
            top[p] = max(top.get(p, leaf.high), leaf.high)
        return top


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = f"{self.path}/data"
        self._offsets = f"{self.path}/offsets"
        self._pointer = Pointer(spark, f"{self.path}/_versions")
        self._files = Files(spark)
        self._seen: tuple[int, dict[str, Any]] = (0, {})
        self._frame: tuple[int, DataFrame | None] = (0, None)

    # ---- reading -------------------------------------------------------------

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The current version, or an older one. A version never changes once published."""
        number = version or self._pointer.newest(self._seen[0])
        if not number:
            return Snapshot()
        if self._seen[0] != number:
            self._seen = self._pointer.load(number)
        return Snapshot.of(*self._seen)

    def exists(self) -> bool:
        return bool(self._pointer.newest(self._seen[0]))

    def read(self, snapshot: Snapshot | None = None,
             keep: Callable[[Leaf], bool] | None = None) -> DataFrame:
        """The table as of ``snapshot``; ``keep`` leaves out whole folders."""
        snap = snapshot or self.snapshot()
        # The files of a version never change, so their listing can be kept with it.
        if keep is None and self._frame[0] == snap.version:
            return self._frame[1]
        leaves = [leaf for leaf in snap.leaves if keep is None or keep(leaf)]
        if leaves:
            df = self._scan(snap, self._paths(snap, leaves))
        else:
            df = self.spark.createDataFrame([], snap.schema)
        if keep is None and snap.version:
            self._frame = (snap.version, df)
        return df

    def offset_sets(self, snap: Snapshot, keep: Callable[[Leaf], bool] | None = None) -> DataFrame:
        """The offsets of the rows that ``read`` gives, as bitmaps: (partition, slot, bitmap, low, high, rows), several of a slot.

        They are read where all folders have them, else made from the coordinates.
        """
        names = [PARTITION, bitmaps.SLOT, bitmaps.BITMAP, "low", "high", "rows"]
        leaves = [leaf for leaf in snap.leaves if keep is None or keep(leaf)]
        if not leaves or any(leaf.offsets is None for leaf in leaves):
            return bitmaps.build(self.read(snap, keep)).select(*names)
        live: dict[str, list[Leaf]] = {}
        for leaf in leaves:
            live.setdefault(leaf.commit, []).append(leaf)
        sets = self.spark.read.option("basePath", self._offsets).parquet(*(f"{self._offsets}/{c}" for c in live))
        if any(len(members) < snap.sizes[c] for c, members in live.items()):
            cols = snap.partition_by
            own = [(leaf.commit.split("=", 1)[1], *(leaf.values[c] for c in cols)) for leaf in leaves]
            form = ", ".join(["commit string", *(f"`{c}` bigint" for c in cols)])
            sets = sets.join(self.spark.createDataFrame(own, form), ["commit", *cols], "left_semi")
        return sets.select(*names)

    def _paths(self, snap: Snapshot, leaves: Sequence[Leaf]) -> list[str]:
        """Commit folders where the whole commit is live, else single leaf folders."""
        live: dict[str, list[Leaf]] = {}
        for leaf in leaves:
            live.setdefault(leaf.commit, []).append(leaf)
        paths = []
        for commit, members in live.items():
            if len(members) == snap.sizes[commit]:
                paths.append(f"{self.data}/{commit}")
            else:
                paths.extend(f"{self.data}/{leaf.path}" for leaf in members)
        return paths

    def _scan(self, snap: Snapshot, paths: Sequence[str]) -> DataFrame:
        return (
            self.spark.read.schema(snap.schema)
            .option("basePath", self.data)
            .parquet(*paths)
            .selectExpr(*[f"`{name}`" for name in snap.schema.names])
        )

    def view_sql(self, snapshot: Snapshot | None = None) -> str:
        """The snapshot as a SELECT over Parquet paths, for a persistent view."""
        snap = snapshot or self.snapshot()
        live: dict[str, list[Leaf]] = {}
        for leaf in snap.leaves:
            live.setdefault(leaf.commit, []).append(leaf)
        branches = []
        for commit, members in live.items():
            have = set(snap.columns[commit]) | set(snap.partition_by)
            items = ", ".join(
                f"CAST({f'`{c.name}`' if c.name in have else 'NULL'} AS "
                f"{c.dataType.simpleString()}) AS `{c.name}`"
                for c in snap.schema
            )
            text = f"SELECT {items} FROM parquet.`{self.data}/{commit}`"
            if len(members) < snap.sizes[commit]:
                text += " WHERE " + " OR ".join(
                    "(" + " AND ".join(
                        f"`{k}` = {sql_literal(v)}" for k, v in leaf.values.items()
                    ) + ")"
                    for leaf in members
                )
            branches.append(text)
        if not branches:
            items = ", ".join(
                f"CAST(NULL AS {c.dataType.simpleString()}) AS `{c.name}`" for c in snap.schema
            )
            return f"SELECT {items} WHERE FALSE"
        return " UNION ALL ".join(branches)

    # ---- writing -------------------------------------------------------------

    def create(self, df: DataFrame, partition_by: Sequence[str] = (), *,
               sort: Sequence[str] = (), ranged: bool = False,
               options: dict[str, str] | None = None,
               props: dict[str, Any] | None = None) -> Snapshot:
        """Write ``df`` as the whole table. ``ranged`` keeps the order it comes in."""
        snap = self.snapshot()
        fresh = Snapshot(
            snap.version, df.schema, list(partition_by),
            props={"sort": list(sort), "options": options or {}, **(props or {})},
        )
        self._add(fresh, df, "as_is" if ranged else "rebalance")
        return self._publish(fresh)

    def append(self, df: DataFrame, *, txn: tuple[str, int] | None = None,
               props: dict[str, Any] | None = None, ranged: bool = False,
               base: Snapshot | None = None) -> Snapshot:
        """Add rows by column name; a ``txn`` that was applied before is a no-op.

        ``base`` is the snapshot from which the rows were computed: a commit since then
        is a ``CommitConflict``. Rows that do not depend on the table need none.
        """
        snap = self._start(base)
        if txn and snap.applied.get(txn[0], -1) >= txn[1]:
            return snap
        self._add(snap, self._aligned(snap, df), "as_is" if ranged else "rebalance")
        return self._publish(snap, txn, props)

    def replace(self, df: DataFrame | None, drop: Callable[[Leaf], bool], *,
                unmoved: DataFrame | None = None, txn: tuple[str, int] | None = None,
                props: dict[str, Any] | None = None, base: Snapshot | None = None) -> Snapshot:
        """Swap the folders chosen by ``drop`` for the rows of ``df`` (none if None).

        ``base`` is the snapshot that ``df`` was computed from, as for ``append``.
        ``unmoved`` are more rows, which come from this table folder by folder and
        are written where they are, without a shuffle.
        """
        snap = self._start(base)
        if txn and snap.applied.get(txn[0], -1) >= txn[1]:
            return snap
        snap.leaves = [leaf for leaf in snap.leaves if not drop(leaf)]
        for rows, how in ((unmoved, "sort"), (df, "rebalance")):
            if rows is not None:
                self._add(snap, self._aligned(snap, rows), how)
        return self._publish(snap, txn, props)

    def add_column(self, name: str, dtype: T.DataType, after: str | None = None) -> Snapshot:
        """Add a nullable column at a position; no data is rewritten."""
        snap = self.snapshot()
        fields = list(snap.schema.fields)
        at = snap.schema.names.index(after) + 1 if after else len(fields)
        fields.insert(at, T.StructField(name, dtype, True))
        snap.schema = T.StructType(fields)
        return self._publish(snap)

    def set_props(self, **props: Any) -> Snapshot:
        return self._publish(self.snapshot(), props=props)

    def compact(self, most: int = 1) -> Snapshot:
        """Rewrite only those partitions that are spread over more than ``most`` commits."""
        snap = self.snapshot()
        spread: dict[tuple, int] = {}
        for leaf in snap.leaves:
            key = tuple(leaf.values.items())
            spread[key] = spread.get(key, 0) + 1

        def crowded(leaf: Leaf) -> bool:
            return spread[tuple(leaf.values.items())] > most

        if not any(crowded(leaf) for leaf in snap.leaves):
            return snap
        return self.replace(self.read(snap, crowded), crowded, base=snap)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete commits that none of the last ``keep`` versions refers to."""
        known = sorted(self._pointer.versions())
        used = {
            leaf.commit for v in known[-keep:] for leaf in self.snapshot(v).leaves
        }
        gone = [name for name in self._files.names(self.data) if name not in used]
        for name in gone:
            self._files.delete(f"{self.data}/{name}")
            self._files.delete(f"{self._offsets}/{name}")
        for v in known[:-keep]:
            self._files.delete(f"{self._pointer.folder}/{v:010d}.json")
        return gone

    def drop(self) -> None:
        """Delete the table with all its versions."""
        self._files.delete(self.path)
        self._seen, self._frame = (0, {}), (0, None)

    # ---- parts ---------------------------------------------------------------

    def _start(self, base: Snapshot | None) -> Snapshot:
        """A snapshot to change: a copy of ``base``, or the current one."""
        return self.snapshot() if base is None else replace(base)

    def _aligned(self, snap: Snapshot, df: DataFrame) -> DataFrame:
        """Columns of ``df`` in table order; one that ``df`` lacks becomes null."""
        extra = set(df.columns) - set(snap.schema.names)
        if extra:
            raise ValueError(f"add these columns to the table first: {sorted(extra)}")
        have = set(df.columns)
        return df.select(*[
            (F.col(f"`{c.name}`") if c.name in have else F.lit(None)).cast(c.dataType).alias(c.name)
            for c in snap.schema
        ])

    def _add(self, snap: Snapshot, df: DataFrame, how: str) -> None:
        commit = f"commit=c{snap.version + 1:06d}x{uuid.uuid4().hex[:8]}"
        target = f"{self.data}/{commit}"
        cols, sort = snap.partition_by, snap.props.get("sort", [])
        if how == "rebalance" and cols:
            # AQE sizes the write tasks: small partitions are joined, large ones split.
            df = df.hint("rebalance", *[F.col(c) for c in cols])
        if how != "as_is" and (cols or sort):
            df = df.sortWithinPartitions(*cols, *[s for s in sort if s not in cols])
        writer = df.write.mode("errorifexists").options(**snap.props.get("options", {}))
        if cols:
            writer = writer.partitionBy(*cols)
        writer.parquet(target)
        leaves = self._leaves(snap, commit)
        snap.leaves = snap.leaves + leaves
        snap.columns = {**snap.columns, commit: df.columns}
        snap.sizes = {**snap.sizes, commit: len(leaves)}

    def _leaves(self, snap: Snapshot, commit: str) -> list[Leaf]:
        cols = snap.partition_by
        if not cols:
            return [Leaf(commit)]
        found = [
            Leaf(f"{commit}/{rel}",
                 {k: int(v) for k, v in (part.split("=", 1) for part in rel.split("/"))})
            for rel in self._files.leaf_dirs(f"{self.data}/{commit}", len(cols))
        ]
        if PARTITION not in cols or not found:
            return found
        # The offsets of the commit stay beside it: coverage is judged by them, not by reading coordinates again.
        sets = f"{self._offsets}/{commit}"
        bitmaps.build(self._scan(snap, [f"{self.data}/{commit}"]), *cols).write.parquet(sets)
        bounds = self.spark.read.parquet(sets).groupBy(*cols).agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"),
            F.sum(F.bitmap_count(bitmaps.BITMAP)).alias("offsets"),
        )
        # One row per folder just written, the same number the listing above returned.
        stats = {tuple(row[c] for c in cols): row for row in bounds.collect()}
        for leaf in found:
            row = stats.get(tuple(leaf.values[c] for c in cols))
            if row is None:
                continue  # no row of the folder has an offset
            leaf.low, leaf.high, leaf.rows, leaf.offsets = row["low"], row["high"], row["rows"], row["offsets"]
        return found

    def _publish(self, snap: Snapshot, txn: tuple[str, int] | None = None,
                 props: dict[str, Any] | None = None) -> Snapshot:
        if txn:
            snap.applied = {**snap.applied, txn[0]: txn[1]}
        if props:
            snap.props = {**snap.props, **props}
        live = {leaf.commit for leaf in snap.leaves}
        snap.columns = {c: v for c, v in snap.columns.items() if c in live}
        snap.sizes = {c: v for c, v in snap.sizes.items() if c in live}
        snap.version = self._pointer.swap(snap.version, snap.document())
        return snap
