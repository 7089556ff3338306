"""Jobs that move rows from the live log to the archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelog.functions.coords import BUCKET, COORDINATES, OFFSET, PARTITION, with_bucket
from lakelog.operators.coverage import Coverage
from lakelog.operators.ordering import range_tasks
from lakelog.sources.store import Snapshot, Table


def _bloom(columns: Sequence[str]) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def archive(table: Table, hot: DataFrame, width: int = 1000,
            bloom: Sequence[str] = (), row_group_bytes: int | None = None) -> Snapshot:
    """Create the archive from the live log, laid out by partition and offset block.

    ``width`` offsets go into one folder, so it is chosen with the size of the
    log: folders should hold some hundred megabytes. Rows inside are sorted by
    offset, and the row-group statistics narrow an offset range further.
    """
    options = _bloom(bloom)
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    return table.create(
        with_bucket(hot.drop(BUCKET), width), [PARTITION, BUCKET],
        sort=[OFFSET], options=options, props={"width": width},
    )


def archive_ordered(table: Table, hot: DataFrame, bloom: Sequence[str] = ()) -> Snapshot:
    """Create an archive in global (timestamp, partition, offset) order."""
    order = [F.col(c) for c in (COORDINATES[2], PARTITION, OFFSET)]
    ordered = hot.repartitionByRange(range_tasks(hot), *order).sortWithinPartitions(*order)
    return table.create(ordered, ranged=True, options=_bloom(bloom))


def append(table: Table, hot: DataFrame, *, by_position: bool = False,
           txn: tuple[str, int] | None = None) -> Snapshot:
    """Append the rows that the archive does not have yet, late ones too.

    Running the job again adds nothing, and two jobs at once cannot add the same
    rows: the second fails with ``CommitConflict``. What is archived is known from
    the pointer where folders have no gaps; else the coordinates of the folders that
    overlap are read. Columns go by name; ``by_position`` takes them in order.
    """
    snap = table.snapshot()
    if by_position:
        names = [c for c in snap.schema.names if c != BUCKET]
        hot = hot.drop(BUCKET).toDF(*names)
    fresh = Coverage.of(table, snap).unarchived(hot)
    if "width" in snap.props:
        fresh = with_bucket(fresh.drop(BUCKET), snap.props["width"])
    return table.append(fresh, txn=txn, base=snap)


def derive(table: Table, source: DataFrame, where: Column, columns: Sequence[Column | str]) -> Snapshot:
    """A smaller archive table: some columns of some rows of another table."""
    return table.create(source.where(where).select(*columns))


def trim_hot(hot: Table, cold: Table) -> int:
    """Drop archived rows from the live log and return how many are left.

    A row goes only if the archive holds it. Folders that the archive covers without a
    gap only leave the pointer; folders that it may hold parts of are rewritten
    with the rest; others are not touched.
    """
    coverage, snap = Coverage.of(cold), hot.snapshot()
    unclear = [leaf for leaf in snap.leaves if not coverage.covers(leaf) and coverage.touches(leaf)]
    paths = {leaf.path for leaf in unclear}
    rest = coverage.unarchived(hot.read(snap, lambda leaf: leaf.path in paths), unclear) if unclear else None
    after = hot.replace(rest, lambda leaf: leaf.path in paths or coverage.covers(leaf), base=snap)
    if any(leaf.rows is None for leaf in after.leaves):
        return hot.read(after).count()
    return sum(leaf.rows for leaf in after.leaves)


def evolve(table: Table, hot: DataFrame, after: dict[str, str] | None = None) -> list[str]:
    """Add the columns of ``hot`` that the archive lacks, at the wanted positions."""
    known = set(table.snapshot().schema.names)
    added = []
    for f in hot.schema:
        if f.name not in known:
            table.add_column(f.name, f.dataType, (after or {}).get(f.name))
            added.append(f.name)
    return added
