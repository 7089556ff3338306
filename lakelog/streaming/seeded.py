"""A change feed whose key state starts from the archive.

The state store knows of every key, archived or seen since, how new it is and whether it lives: three numbers a key, no
payload. The archive gives the first state, once, when the job starts for the first time; from then on the job tells new keys
from changed ones, and drops deletes of unknown keys and events older than what is archived, without a look at the archive.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakelog.functions.coords import COORDINATES, OFFSET, PARTITION
from lakelog.operators import cdc
from lakelog.sources.store import Table
from lakelog.streaming.jobs import due, run

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KNOWN = "packed binary"
GROUPS = 64  # groups of keys for each bucket of the archive
TOLD = "op string, body string"
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_index() -> StatefulProcessor:
    """Made here, it travels with its code: Spark's own worker for it on the driver need not find this package."""

    def newest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values("at", kind="stable").drop_duplicates("name", keep="last")

    class KeyIndex(StatefulProcessor):
        """For each key of a group the coordinates of its newest event or archived row, and whether that was a delete."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._known = handle.getValueState("known", KNOWN)

        def _load(self) -> pd.DataFrame:
            if self._known.exists():
                return pa.ipc.open_stream(bytes(self._known.get()[0])).read_pandas()
            return pd.DataFrame({"name": pd.Series(dtype=object), "part": pd.Series(dtype="int64"), "at": pd.Series(dtype="int64"), "gone": pd.Series(dtype=bool)})

        def _keep(self, known: pd.DataFrame) -> None:
            table, out = pa.Table.from_pandas(known, preserve_index=False), io.BytesIO()
            with pa.ipc.new_stream(out, table.schema) as stream:
                stream.write_table(table)
            self._known.update((out.getvalue(),))

        def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
            # an archive has a row for a key; repeats do no harm
            first = initialState[["name", "part", "at", "gone"]].astype({"part": "int64", "at": "int64", "gone": bool})
            self._keep(newest(pd.concat([self._load(), first])))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            best = None
            for chunk in rows:
                best = newest(chunk if best is None else pd.concat([best, chunk]))
            known = self._load()
            found = best.merge(known.astype({"part": "Int64", "at": "Int64"}), "left", "name", suffixes=("", "_known"))
            stale = (found["part_known"] == found["part"]) & (found["at"] < found["at_known"])
            found = found[~stale.fillna(False).astype(bool)]
            gone, lived = found["op"] == "d", found["gone"].eq(False)
            fresh = found[["name", "part", "at"]].astype({"part": "int64", "at": "int64"}).assign(gone=gone)
            if len(fresh):
                self._keep(pd.concat([known, fresh]).drop_duplicates("name", keep="last"))
            op = lived.map({True: "u", False: "c"}).mask(gone, "d")
            yield pd.DataFrame({"op": op, "body": found["body"]})[lived | ~gone]

        def close(self) -> None:
            pass

    return KeyIndex()


def changes(stream: DataFrame, archived: DataFrame, key: str, groups: int) -> DataFrame:
    """The changes that ``stream`` makes to a keyed archive, at most one of a key in a batch, as a change log.

    ``op`` says what a change does: 'c' to a key that is not there, 'u' or 'd' to one that is. A null key is a key.
    Keys are kept in ``groups`` groups, the same number for as long as the state lives; a batch rewrites those it touches.
    """
    name = lambda column: F.to_json(F.struct(column.cast("string").alias("k")))  # noqa: E731  never null
    log = stream.select("op", "before", "after", *COORDINATES)
    asked = F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))
    events = log.select(
        name(asked).alias("name"), "op", F.col(PARTITION).cast("int").alias("part"), F.col(OFFSET).cast("bigint").alias("at"),
        F.to_json(F.struct("before", "after", *COORDINATES), EXACT).alias("body"),
    )
    gone = F.col(cdc.DELETED) if cdc.DELETED in archived.columns else F.lit(False)
    group = F.pmod(F.xxhash64("name"), F.lit(groups)).alias("group")
    first = archived.select(
        name(F.col(key)).alias("name"), F.col(PARTITION).cast("int").alias("part"),
        F.col(OFFSET).cast("bigint").alias("at"), gone.alias("gone"),
    )
    told = events.select("*", group).groupBy("group").transformWithStateInPandas(
        statefulProcessor=key_index(), outputStructType=TOLD, outputMode="Update", timeMode="None",
        initialState=first.select("*", group).groupBy("group"),
    )
    body = F.from_json("body", log.drop("op").schema, EXACT).alias("e")
    return told.select("op", body).select("op", "e.*")


def seeded_stream(
    stream: DataFrame, key: str, table: Table, pending: Table, checkpoint: str, *, share: float = cdc.FOLD_SHARE,
    roll_after: int | None = None, name: str = "seeded", every: str | None = None,
) -> StreamingQuery:
    """Like ``jobs.latest_stream``, with a state that starts from the archive ``table``.

    ``pending`` takes in only what changes the archive. The key in the state must be the archive's, so a restart with the same
    checkpoint goes on from the state it had, and other writers than this job must not roll into ``table``. Such a state needs
    the RocksDB store, which the job takes whatever the session is set to.
    """
    names, groups = pending.snapshot().schema.names, GROUPS * table.snapshot().props["buckets"]

    def handle(df: DataFrame, n: int) -> None:
        pending.append(df.select(*names), txn=(name, n))
        if due(table, pending, share, roll_after, n):
            cdc.fold_pending(table, pending, txn=(f"{name}-fold", n))

    conf = table.spark.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)  # a job keeps the settings it was started with
    try:
        return run(changes(stream, table.read(), key, groups), handle, checkpoint, every=every, mode="update")
    finally:
        conf.unset(PROVIDER) if before is None else conf.set(PROVIDER, before)
