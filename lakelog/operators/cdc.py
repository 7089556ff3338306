"""Change-log views: current state, tombstones, merged state and the atomic roll.

A change log has ``op`` ('c', 'u' or 'd'), nullable structs ``before`` and
``after``, and the log coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelog.functions.coords import COORDINATES, OFFSET, PARTITION, TIMESTAMP
from lakelog.operators.ordering import input_bytes
from lakelog.sources.store import Table
from lakelog.sources.workdir import new_folder

KEY_BUCKET = "key_bucket"
DELETED = "is_deleted"
BROADCAST_KEYS = 1_000_000
BROADCAST_BYTES = 64 << 20
FOLD_SHARE = 0.1  # pending bytes to archived bytes at which a fold is worth its rewrite


def payload_names(log: DataFrame) -> list[str]:
    return log.schema["after"].dataType.names


def unwrap(log: DataFrame) -> DataFrame:
    """Payload columns of every event, from ``after`` or, for a delete, ``before``."""
    return log.select(
        "op",
        *[F.coalesce(F.col(f"after.{c}"), F.col(f"before.{c}")).alias(c)
          if c_in_before(log, c) else F.col(f"after.{c}").alias(c)
          for c in payload_names(log)],
        *COORDINATES,
    )


def c_in_before(log: DataFrame, column: str) -> bool:
    return column in log.schema["before"].dataType.names


def latest(log: DataFrame, key: str) -> DataFrame:
    """The newest event per key.

    ``max_by`` is combined before the shuffle, so a key that holds most of the
    events sends one row per map task and not its whole history.
    """
    rows = log.select(
        F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")).alias("__key"),
        "op", F.col("after").alias("__after"), *COORDINATES,
    )
    newest = rows.groupBy("__key").agg(
        F.max_by(F.struct("op", "__after", *COORDINATES), F.col(OFFSET)).alias("e")
    )
    return newest.select("__key", "e.*")


def current(log: DataFrame, key: str) -> DataFrame:
    """Live rows of the log: one per key, deleted keys absent."""
    live = latest(log, key).where(F.col("op") != "d")
    return live.select("__after.*", *COORDINATES)


def deletes(log: DataFrame, key: str) -> DataFrame:
    """Keys whose newest event is a delete, with the offset of that event."""
    keyed = log.select(
        F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")).alias(key), "op", PARTITION, OFFSET
    )
    last = keyed.groupBy(key).agg(F.max(F.struct(OFFSET, "op", PARTITION)).alias("e"))  # no payload in the shuffle
    return last.where("e.op = 'd'").select(
        key, f"e.{PARTITION}", F.col(f"e.{OFFSET}").alias("delete_kafka_offset")
    )


def hide_deleted(cold: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    gone = tombstones.select(F.col(key).alias("__gone"))
    return cold.join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti")


def _newer(cold_part: Column, cold_off: Column, part: Column, off: Column) -> Column:
    """Whether a hot event is at least as new as the archived row of its key."""
    return cold_off.isNull() | (cold_part != part) | (off >= cold_off)


def _fold(cold: DataFrame, state: DataFrame, key: str, how: str = "full_outer") -> DataFrame:
    """Archived rows and newest events, with ``DELETED`` set where the key is gone.

    One join of the archive with one row per live key, instead of an anti join
    and a union that would scan the live log twice.
    Payload fields that only the log has come after the columns of the archive. A null key is a key like others.
    """
    names = [c for c in cold.columns if c not in (*COORDINATES, DELETED, key)]
    names += _added(cold, state, key)
    both = cold.withColumn("__archived", F.lit(True)).alias("c").join(
        state.withColumn("__live", F.lit(True)).alias("h"), F.col(f"c.{key}").eqNullSafe(F.col("h.__key")), how
    )
    hot_wins = F.col("h.__live").isNotNull() & (
        F.col("c.__archived").isNull()
        | _newer(F.col(f"c.{PARTITION}"), F.col(f"c.{OFFSET}"),
                 F.col(f"h.{PARTITION}"), F.col(f"h.{OFFSET}"))
    )
    after = set(state.schema["__after"].dataType.names)
    was_deleted = F.col(f"c.{DELETED}") if DELETED in cold.columns else F.lit(False)

    def pick(name: str) -> Column:
        if name == KEY_BUCKET:
            return F.col(f"c.{name}").alias(name)
        new = F.col(f"h.__after.{name}") if name in after else F.lit(None)
        old = F.col(f"c.{name}") if name in cold.columns else F.lit(None)
        return F.when(hot_wins, new).otherwise(old).alias(name)

    return both.select(
        F.coalesce(F.col(f"c.{key}"), F.col("h.__key")).alias(key),
        *[pick(n) for n in names],
        *[F.when(hot_wins, F.col(f"h.{n}")).otherwise(F.col(f"c.{n}")).alias(n)
          for n in COORDINATES],
        F.when(hot_wins, F.col("h.op") == "d").otherwise(was_deleted).alias(DELETED),
    ).select(*[n for n in cold.columns if n != DELETED], *_added(cold, state, key), DELETED)


def _added(cold: DataFrame, state: DataFrame, key: str) -> list[str]:
    """Payload fields of the log that the archive lacks."""
    return [n for n in state.schema["__after"].dataType.names if n not in cold.columns and n != key]


def _inserts(state: DataFrame, cold: DataFrame, key: str) -> DataFrame:
    """Newest events as rows like those of ``cold``."""
    after = set(state.schema["__after"].dataType.names)
    types = {f.name: f.dataType for f in cold.schema}
    return state.select(
        F.col("__key").alias(key),
        *[(F.col(f"__after.{n}") if n in after else F.lit(None)).cast(types[n]).alias(n)
          for n in cold.columns if n not in (*COORDINATES, KEY_BUCKET, DELETED, key)],
        *COORDINATES, (F.col("op") == "d").alias(DELETED),
    )


def merged(cold: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Archive and live log as one state: the live event of a key wins."""
    cold = cold.drop(KEY_BUCKET)
    return _fold(cold, latest(log, key), key).where(~F.col(DELETED)).drop(DELETED)


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def create_archive(table: Table, rows: DataFrame, key: str, buckets: int) -> None:
    """A keyed archive in ``buckets`` folders, the unit that a roll rewrites."""
    table.create(
        rows.withColumn(DELETED, F.lit(False)).withColumn(KEY_BUCKET, key_bucket(key, buckets)),
        [KEY_BUCKET], sort=[key],
        props={"key": key, "buckets": buckets},
    )


def read_archive(table: Table) -> DataFrame:
    return table.read().where(~F.col(DELETED)).drop(KEY_BUCKET, DELETED)


def roll(table: Table, log: DataFrame, *, keep_deleted: bool = False,
         txn: tuple[str, int] | None = None) -> int:
    """Fold the live log into the archive and publish the result at once.

    Deleted keys leave, changed keys are updated with all columns and their
    coordinates, new keys are added, and a delete of an unknown key is ignored.
    A null key is a key like others.
    Only key buckets that the log touches are read and rewritten. Rolling the
    same log again changes nothing. Returns the number of buckets rewritten.

    ``log`` may be one piece of a longer log. With ``keep_deleted`` a deleted
    key stays as a hidden row, so that an older event of that key in a later
    piece does not bring it back; ``forget_deleted`` removes such rows.

    Payload fields that the archive lacks become columns of it first. The roll starts
    from one snapshot: another commit meanwhile is a ``CommitConflict``.

    The newest events are written first: the log is read once, and their number
    is known. If they are few, they go to the archive, which is then neither
    shuffled nor moved to other folders; else both sides meet in one full join.
    """
    snap = table.snapshot()
    if txn and snap.applied.get(txn[0], -1) >= txn[1]:
        return 0
    for f in log.schema["after"].dataType:
        if f.name not in snap.schema.names:
            snap = table.add_column(f.name, f.dataType)
    spark, key, buckets = table.spark, snap.props["key"], snap.props["buckets"]
    newest = latest(log, key).withColumn(
        "__key", F.col("__key").cast(snap.schema[key].dataType))
    folder = new_folder(spark, "newest")
    newest.write.parquet(folder)
    state = spark.read.schema(newest.schema).parquet(folder)
    # At most one row per bucket, and the number of buckets is a table setting.
    counts = {
        r["b"]: r["n"] for r in state.groupBy(key_bucket("__key", buckets).alias("b"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not counts:
        return 0

    def hit(leaf) -> bool:
        return leaf.values[KEY_BUCKET] in counts

    before = table.read(snap, hit)
    kept, added = None, None
    if sum(counts.values()) <= BROADCAST_KEYS and input_bytes(state) <= BROADCAST_BYTES:
        kept = _fold(before, F.broadcast(state), key, "left")
        asked = state.select(F.col("__key").alias("__asked"))
        known = before.select(F.col(key).alias("__known")).join(
            F.broadcast(asked), F.col("__known").eqNullSafe(F.col("__asked")), "left_semi")
        # ``known`` is a part of the keys in ``state``, so it is as small.
        fresh = state.join(F.broadcast(known.distinct()), F.col("__key").eqNullSafe(F.col("__known")), "left_anti")
        added = _inserts(fresh, before, key)
    else:
        added = _fold(before.drop(KEY_BUCKET), state, key)
    added = added.withColumn(KEY_BUCKET, key_bucket(key, buckets))
    if not keep_deleted:
        added = added.where(~F.col(DELETED))
        kept = None if kept is None else kept.where(~F.col(DELETED))
    table.replace(added, hit, unmoved=kept, txn=txn, base=snap)
    return len(counts)


def newest_events(log: DataFrame, key: str) -> DataFrame:
    """The log with only the newest event of each key, still as a change log."""
    kept = log.schema["before"].dataType
    before = F.struct(*[
        (F.col("__key") if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in kept
    ])
    return latest(log, key).select(
        "op", before.alias("before"), F.col("__after").alias("after"), *COORDINATES
    )


def create_pending(table: Table, log: DataFrame, key: str) -> None:
    """An empty table for events that the archive has not taken in yet."""
    table.create(newest_events(log.where(F.lit(False)), key), props={"key": key})


def state(table: Table, pending: Table) -> DataFrame:
    """Archive and pending events as one state."""
    key = table.snapshot().props["key"]
    return merged(table.read(), pending.read(), key)


def fold_is_due(table: Table, pending: Table, share: float = FOLD_SHARE) -> bool:
    """Whether the pending events have come to ``share`` of the bytes of the archive."""
    return input_bytes(pending.read()) >= share * input_bytes(table.read())


def fold_pending(table: Table, pending: Table, *, txn: tuple[str, int] | None = None) -> int:
    """Roll the pending events into the archive and drop them from ``pending``.

    If the job stops in between, the events are rolled again, without effect.
    """
    snap = pending.snapshot()
    if not snap.leaves:
        return 0
    done = {leaf.path for leaf in snap.leaves}
    buckets = roll(table, pending.read(snap), keep_deleted=True, txn=txn)
    pending.replace(None, lambda leaf: leaf.path in done)
    return buckets


def forget_deleted(table: Table) -> None:
    """Rewrite the buckets that hold hidden rows of deleted keys."""
    snap = table.snapshot()
    rows = table.read(snap)
    # At most one row per bucket.
    dirty = {
        r[0] for r in rows.where(DELETED).select(KEY_BUCKET).distinct().collect()
    }
    if dirty:
        def hit(leaf) -> bool:
            return leaf.values[KEY_BUCKET] in dirty

        table.replace(table.read(snap, hit).where(~F.col(DELETED)), hit, base=snap)
