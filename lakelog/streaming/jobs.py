"""Jobs that run for as long as the log grows, or until it is caught up.

Every job hands whole micro-batches to the batch operators. The batch number is
stored in the same pointer as the data, so a batch that is retried after a
failure is not applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakelog.functions.coords import BUCKET, with_bucket
from lakelog.operators import archive, cdc
from lakelog.operators.coverage import Coverage
from lakelog.sources.store import Table


def run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
        *, every: str | None = None, mode: str = "append") -> StreamingQuery:
    """Start a job; without ``every`` it takes in what there is and stops."""
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    if every is None:
        query.awaitTermination()
    return query


def ingest(stream: DataFrame, hot: Table, checkpoint: str, *, name: str = "ingest",
           every: str | None = None, compact_after: int | None = None) -> StreamingQuery:
    """Keep the live table current: each micro-batch becomes one commit.

    A table laid out by partition and offset block (``archive.archive``) stays so, and
    with ``compact_after`` folders spread over more commits than that are joined. As the log
    moves on, only its youngest blocks are.
    """

    def handle(df: DataFrame, n: int) -> None:
        width = hot.snapshot().props.get("width")
        hot.append(with_bucket(df.drop(BUCKET), width) if width else df, txn=(name, n))
        if compact_after and (n + 1) % compact_after == 0:
            hot.compact(compact_after)

    return run(stream, handle, checkpoint, every=every)


def archive_stream(stream: DataFrame, cold: Table, checkpoint: str, *, name: str = "archive",
                   every: str | None = None, compact_after: int | None = None) -> StreamingQuery:
    """Archive at a chosen cadence. Folders spread over many commits are rewritten.

    Files of a feed may be listed out of order; rows below the boundary are taken
    unless the archive has them.
    """

    def handle(df: DataFrame, n: int) -> None:
        archive.append(cold, df, txn=(name, n))
        if compact_after and (n + 1) % compact_after == 0:
            cold.compact(compact_after)

    return run(stream, handle, checkpoint, every=every)


def roll_stream(stream: DataFrame, table: Table, pending: Table, checkpoint: str, *,
                share: float = cdc.FOLD_SHARE, roll_after: int | None = None,
                name: str = "roll", every: str | None = None) -> StreamingQuery:
    """Follow a change log: ``cdc.state(table, pending)`` is current after each batch.

    A batch costs what it holds: its newest events are appended to ``pending``.
    The archive is rewritten only when the pending events have come to ``share`` of
    its bytes (and every ``roll_after`` batches, if that is wanted), so what is
    written stays in proportion to what has changed. Deleted keys stay as hidden
    rows, so batches may come in any order.
    """
    key = pending.snapshot().props["key"]

    def handle(df: DataFrame, n: int) -> None:
        pending.append(cdc.newest_events(df, key), txn=(name, n))
        if due(table, pending, share, roll_after, n):
            cdc.fold_pending(table, pending, txn=(f"{name}-fold", n))

    return run(stream, handle, checkpoint, every=every)


def due(table: Table, pending: Table, share: float, roll_after: int | None, n: int) -> bool:
    return bool(roll_after and (n + 1) % roll_after == 0) or cdc.fold_is_due(table, pending, share)


def latest_stream(stream: DataFrame, key: str, table: Table, pending: Table, checkpoint: str,
                  *, share: float = cdc.FOLD_SHARE, roll_after: int | None = None,
                  name: str = "latest", every: str | None = None) -> StreamingQuery:
    """Like ``roll_stream``, with the newest event per key kept as stream state.

    The state store decides which event is the newest, so only keys that a batch
    touches are handed on, each with its newest event of all batches so far.
    """

    def handle(df: DataFrame, n: int) -> None:
        pending.append(df, txn=(name, n))
        if due(table, pending, share, roll_after, n):
            cdc.fold_pending(table, pending, txn=(f"{name}-fold", n))

    newest = cdc.newest_events(stream, key)
    return run(newest, handle, checkpoint, every=every, mode="update")


def replay_stream(spark: SparkSession, cold: Table, stream: DataFrame, sink: Table,
                  checkpoint: str, *, name: str = "replay",
                  every: str | None = None) -> StreamingQuery:
    """Deliver the archive first and then the rows of the live log that it lacks.

    The version of the archive that is delivered is kept with the backfill, so a restart
    continues with the same cut and no record is missed or delivered twice, also where
    the archive has gaps. A vacuum of the archive has to keep that version.
    """
    if not sink.exists():
        snap = cold.snapshot()
        sink.create(cold.read(snap), props={"archived": snap.version})
    version = sink.snapshot().props.get("archived")
    if version is None:
        raise ValueError("the sink does not say which version of the archive it holds; replay into a new one")
    coverage = Coverage.of(cold, cold.snapshot(version))

    def handle(df: DataFrame, n: int) -> None:
        sink.append(coverage.unarchived(df), txn=(name, n))

    return run(stream, handle, checkpoint, every=every)
