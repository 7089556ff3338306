"""Reading a log in order: whole, by page, resumed, filtered, or re-sorted."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.functions import bitmaps
from lakelog.functions.coords import OFFSET, PARTITION, TIMESTAMP, offset_range
from lakelog.operators.index import OffsetIndex, lookup
from lakelog.operators.ordering import Ordered, range_tasks, write_ordered
from lakelog.operators.tiers import Topic
from lakelog.sources.files import Pointer

REPLAY_OFFSET = "replay_offset"
MOST_PARTS = 8  # parts of a frozen order before neighbours are joined


def replay(log: DataFrame, start: int | None = None, width: int | None = None) -> DataFrame:
    """The log in order per partition, from offset ``start`` on."""
    rows = log if start is None else log.where(offset_range(low=start, width=width))
    return rows.orderBy(PARTITION, OFFSET)


def _cut(borders: list[tuple[int, int]], first: int = 0) -> str:
    """The number of borders (partition, offset) that a row is not before, as SQL: a search by halves."""
    if not borders:
        return str(first)
    half = len(borders) // 2
    p, at = borders[half]
    before = f"{PARTITION} < {p} OR ({PARTITION} = {p} AND {OFFSET} < {at})"
    return f"IF({before}, {_cut(borders[:half], first)}, {_cut(borders[half + 1 :], first + half + 1)})"


def replay_topic(topic: Topic, start: int | None = None, tasks: int | None = None) -> DataFrame:
    """Both tiers in order per partition, like ``replay``, without sampling: a stored log knows where its offsets lie.

    The folders in the pointers give borders between ``tasks`` runs of about as many rows, and a row goes straight to its run.
    Rows that arrive meanwhile lie between the same borders. Topics with a side that is no stored log are
    sorted as ``replay`` does.
    """
    log, folders = topic.merged(), topic.folders()
    if not folders:
        return replay(log, start, topic.width)
    tasks = tasks or range_tasks(log)
    share, borders, run = sum(rows for *_, rows in folders) / tasks, [], 0
    for p, low, rows in folders:
        if run >= share * (len(borders) + 1) and (not borders or (p, low) > borders[-1]):
            borders.append((p, low))
        run += rows
    rows = log if start is None else log.where(offset_range(low=start, width=topic.width))
    number = F.expr(f"CAST({_cut(borders)} AS INT)")
    return rows.repartitionById(len(borders) + 1, number).sortWithinPartitions(PARTITION, OFFSET)


def starts(log: DataFrame) -> DataFrame:
    """The first retained offset of each partition."""
    return log.groupBy(PARTITION).agg(F.min(OFFSET).alias("start_offset"))


def page(log: DataFrame, partition: int, position: int, size: int,
         width: int | None = None) -> DataFrame:
    """The next ``size`` records of a partition at or after ``position``.

    A page is looked for in a short offset range first. The range is widened
    only while it holds too few records, so a page never sorts the rest of the log.
    """
    span, end = 2 * size, None
    while True:
        part = log.where(offset_range(position, position + span, partition, width))
        if end is not None and position + span > end:
            break
        if part.limit(size).count() >= size:
            break
        if end is None:
            tail = log.where(offset_range(position, None, partition, width))
            end = tail.agg(F.max(OFFSET)).first()[0]
            if end is None:
                break
        span *= 16
    return part.orderBy(OFFSET).limit(size)


def page_topic(topic: Topic, partition: int, position: int, size: int) -> DataFrame:
    """The same page of both tiers of a topic, read by one job wherever records are rare.

    How many records lie in each slot of offsets is known from the bitmaps that commits keep, so the end of the page is
    found before any record is read: at most ``size`` + 1 small rows come to the driver. Topics with a side that is no stored
    log are searched as ``page`` does.
    """
    sets = topic.offset_sets()
    if sets is None:
        return page(topic.merged(), partition, position, size, topic.width)
    first = bitmaps.slot_of(position)
    ahead = sets.where((F.col(PARTITION) == partition) & (F.col(bitmaps.SLOT) >= first))
    counts = bitmaps.unite(ahead).select(bitmaps.SLOT, F.bitmap_count(bitmaps.BITMAP).alias("n"))
    end, found = None, 0
    for slot, n in counts.orderBy(bitmaps.SLOT).limit(size + 1).collect():
        found += n if slot > first else 0  # of the first slot some may lie before the position
        if found >= size:
            end = bitmaps.end_of(slot)
            break
    return topic.merged().where(offset_range(position, end, partition, topic.width)).orderBy(OFFSET).limit(size)


class Progress:
    """Committed positions per consumer group, topic and partition."""

    def __init__(self, spark: SparkSession, folder: str):
        self._pointer = Pointer(spark, folder)

    def position(self, group: str, topic: str) -> dict[int, int]:
        _, doc = self._pointer.load()
        return {int(p): at for p, at in doc.get(group, {}).get(topic, {}).items()}

    def commit(self, group: str, topic: str, positions: dict[int, int]) -> None:
        """Store the next position to read, per partition."""
        version, doc = self._pointer.load()
        topics = doc.setdefault(group, {})
        topics[topic] = {**topics.get(topic, {}), **{str(p): at for p, at in positions.items()}}
        self._pointer.swap(version, doc)

    def commit_page(self, group: str, topic: str, rows: DataFrame, offset: str = OFFSET) -> None:
        """Commit the position after the last record of a page."""
        last = rows.groupBy(PARTITION).agg(F.max(offset).alias("at")) \
            if offset == OFFSET else rows.agg(F.max(offset).alias("at"))
        done = {
            (r[PARTITION] if offset == OFFSET else 0): r["at"] + 1
            for r in last.collect() if r["at"] is not None
        }
        if done:
            self.commit(group, topic, done)


def resume(log: DataFrame, progress: Progress, group: str, topic: str, partition: int,
           size: int, width: int | None = None) -> DataFrame:
    """The page after the group's committed position."""
    at = progress.position(group, topic).get(partition, 0)
    return page(log, partition, at, size, width)


@dataclass
class VirtualTopic:
    """A named part of a log. With ``field`` and ``value`` an index can serve it."""

    name: str
    source: Callable[[], DataFrame]
    where: str | None = None
    field: str | None = None
    value: Any = None
    expression: str = "$field"

    def read(self, indexes: tuple[OffsetIndex, ...] = (), bucket_width: int | None = None) -> DataFrame:
        log = self.source()
        if self.field:
            log = lookup(log, self.field, self.value, self.expression, indexes, bucket_width)
        return log.where(F.expr(self.where)) if self.where else log


def gaps(log: DataFrame) -> DataFrame:
    """Missing offset ranges inside each partition.

    One scan of the offsets: they become bitmaps before the shuffle, so no record is sorted or sent to a neighbour.
    """
    return _missing(bitmaps.build(log.select(PARTITION, OFFSET)))


def gaps_topic(topic: Topic) -> DataFrame:
    """The same of all tiers of a topic; stored ones answer from the bitmaps of their commits, without reading records."""
    sets = topic.offset_sets()
    return gaps(topic.merged()) if sets is None else _missing(sets)


def _missing(sets: DataFrame) -> DataFrame:
    return bitmaps.gaps(sets).withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1)


def contiguity(log: DataFrame) -> DataFrame:
    """Per partition: bounds, records, and whether every offset is there."""
    return log.groupBy(PARTITION).agg(
        F.min(OFFSET).alias("first_offset"),
        F.max(OFFSET).alias("last_offset"),
        F.count(F.lit(1)).alias("records"),
        (F.max(OFFSET) - F.min(OFFSET) + 1 - F.count(F.lit(1))).alias("missing"),
    )


def batch_statistics(log: DataFrame, offset: str, size: int) -> DataFrame:
    """One row per fetch of ``size`` offsets: records, first and last offset."""
    batch = F.floor(F.col(offset) / size).cast("bigint")
    return log.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
    )


@dataclass
class Rule:
    """How a consumer group wants to read a topic; groups without one read it as it is."""

    group: str
    topic: str
    filter: str | None = None
    order_by: str = f"{TIMESTAMP} ASC"
    tier: str = "merged"

    def select(self, log: DataFrame) -> DataFrame:
        return log.where(F.expr(self.filter)) if self.filter else log

    def order(self) -> list[Column]:
        """The order with the coordinates as tie-breakers, so that it is total."""
        out = []
        for item in self.order_by.split(","):
            name, _, direction = item.strip().rpartition(" ")
            if direction.upper() not in ("ASC", "DESC"):
                name, direction = item.strip(), "ASC"
            column = F.expr(name)
            out.append(column.desc() if direction.upper() == "DESC" else column.asc())
        return [*out, F.col(PARTITION), F.col(OFFSET)]


class RuleBook:
    def __init__(self, spark: SparkSession, folder: str):
        self._pointer = Pointer(spark, folder)

    def put(self, rule: Rule) -> None:
        version, doc = self._pointer.load()
        doc[f"{rule.group}/{rule.topic}"] = asdict(rule)
        self._pointer.swap(version, doc)

    def get(self, group: str, topic: str) -> Rule | None:
        _, doc = self._pointer.load()
        found = doc.get(f"{group}/{topic}")
        return Rule(**found) if found else None


def reorder(log: DataFrame, rule: Rule) -> DataFrame:
    """Filtered and re-sorted log, numbered 0, 1, 2, ... without gaps."""
    ordered = write_ordered(rule.select(log), rule.order(), "reordered")
    return ordered.numbered(ordered.read(log.sparkSession), REPLAY_OFFSET)


class ReorderedLog:
    """A re-sorted log whose numbers stay fixed while its source grows.

    Rows that arrive later are numbered after the last number and sorted among
    themselves, so a position that a consumer has committed stays valid. That holds for rows of
    any offset: what is taken in is known by bitmaps of offsets, not by the highest one.
    """

    def __init__(self, spark: SparkSession, folder: str, rule: Rule, most_parts: int = MOST_PARTS):
        self.spark, self.rule, self.folder, self.most_parts = spark, rule, folder.rstrip("/"), most_parts
        self._pointer = Pointer(spark, f"{self.folder}/_versions")
        self._parts: dict[str, tuple[Ordered, DataFrame]] = {}

    def extend(self, log: DataFrame) -> int:
        """Take in the rows that were not numbered so far, late ones too; returns the next number.

        Rows without an offset are no rows of a log. More than ``most_parts`` parts are joined, the smallest neighbours
        first, without new numbers.
        """
        version, doc = self._pointer.load()
        parts, seen = doc.get("parts", []), doc.get("seen", [])
        start = parts[-1]["start"] + parts[-1]["rows"] if parts else 0
        fresh = bitmaps.outside(log, self._sets(seen)) if seen else log
        # Written first: the log may grow, and these are the offsets that this part is made of.
        own = self._new("offsets", version)
        bitmaps.build(fresh).select(PARTITION, bitmaps.SLOT, bitmaps.BITMAP).write.parquet(own)
        taken = self._sets([own])
        if doc.get("schema") and taken.isEmpty():
            return start
        ordered = write_ordered(
            self.rule.select(bitmaps.inside(fresh, taken)), self.rule.order(), "part", self._new("part", version))
        if ordered.rows:
            parts = [*parts, self._entry(ordered, ordered.schema, start)]
        seen = [*seen, own]
        if len(seen) > self.most_parts:
            joined = self._new("joined-offsets", version)
            bitmaps.unite(self._sets(seen)).write.parquet(joined)
            seen = [joined]
        while len(parts) > self.most_parts:
            parts = self._join(parts, version)
        self._pointer.swap(version, {"parts": parts, "seen": seen, "schema": log.schema.jsonValue()})
        return start + ordered.rows

    def _new(self, label: str, version: int) -> str:
        return f"{self.folder}/{label}-{version + 1:06d}-{uuid.uuid4().hex[:8]}"

    def _sets(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*folders)

    @staticmethod
    def _entry(ordered: Ordered, schema: T.StructType, start: int) -> dict[str, Any]:
        return {
            "folder": ordered.folder, "start": start, "rows": ordered.rows,
            "bases": ordered.bases, "schema": schema.jsonValue(),
        }

    def _join(self, parts: list[dict[str, Any]], version: int) -> list[dict[str, Any]]:
        """The two neighbours with the fewest rows written as one part, in the order of their numbers."""
        at = min(range(len(parts) - 1), key=lambda k: parts[k]["rows"] + parts[k + 1]["rows"])
        pair = [
            ordered.numbered(df, REPLAY_OFFSET, p["start"]) for p in parts[at : at + 2] for ordered, df in [self._part(p)]
        ]
        rows = pair[0].unionByName(pair[1], allowMissingColumns=True)
        ordered = write_ordered(rows, [F.col(REPLAY_OFFSET)], "part", self._new("joined", version))
        # the numbers follow from the order, so they are not read back
        schema = T.StructType([f for f in ordered.schema if f.name != REPLAY_OFFSET])
        return [*parts[:at], self._entry(ordered, schema, parts[at]["start"]), *parts[at + 2 :]]

    def read(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """All numbered rows, or those with ``low <= number < high``; none before the first ``extend``
        has found any."""
        _, doc = self._pointer.load()
        if not doc:
            raise ValueError("nothing was numbered yet: call extend first")
        if not doc["parts"]:
            schema = T.StructType.fromJson(doc["schema"]).add(REPLAY_OFFSET, T.LongType())
            return self.spark.createDataFrame([], schema)
        end = doc["parts"][-1]["start"] + doc["parts"][-1]["rows"]
        lo, hi = low or 0, end if high is None else high
        pieces = []
        for p in doc["parts"]:
            if p["start"] >= hi or p["start"] + p["rows"] <= lo:
                continue
            ordered, df = self._part(p)
            if lo <= p["start"] and p["start"] + p["rows"] <= hi:
                pieces.append(ordered.numbered(df, REPLAY_OFFSET, p["start"]))
            else:
                pieces.append(ordered.slice(df, REPLAY_OFFSET, lo, hi, p["start"]))
        if not pieces:
            ordered, df = self._part(doc["parts"][0])
            return ordered.numbered(df.where("FALSE"), REPLAY_OFFSET)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)

    def _part(self, part: dict[str, Any]) -> tuple[Ordered, DataFrame]:
        """A numbered part. Its files never change, so their listing is kept."""
        folder = part["folder"]
        if folder not in self._parts:
            ordered = Ordered(folder, T.StructType.fromJson(part["schema"]),
                              [tuple(b) for b in part["bases"]], part["rows"])
            self._parts[folder] = (ordered, ordered.read(self.spark))
        return self._parts[folder]

    def page(self, position: int, size: int) -> DataFrame:
        """``size`` records from a position on, in order; no more than those are sorted."""
        rows = self.read(position, position + size)
        return rows.repartition(1).sortWithinPartitions(REPLAY_OFFSET)

    def pages(self, position: int, size: int, ahead: int = 5) -> Iterator[pa.Table]:
        """Pages of ``size`` records from a position to the end, in order, ``ahead`` of them by one job.

        The caller holds ``size * ahead`` records at a time.
        """
        while True:
            rows = self.read(position, position + size * ahead).toArrow().sort_by(REPLAY_OFFSET)
            for at in range(0, rows.num_rows, size):
                yield rows.slice(at, size)
            position += rows.num_rows
            if rows.num_rows < size * ahead:
                return

    def resume(self, progress: Progress, size: int) -> DataFrame:
        at = progress.position(self.rule.group, self.rule.topic).get(0, 0)
        return self.page(at, size)


def read_as_group(group: str, topic: str, tiers: Callable[[str], DataFrame],
                  rules: RuleBook, folder: str | None = None) -> DataFrame:
    """The topic as the group sees it; ``replay_offset`` is the raw offset without a rule.

    With ``folder`` the group's order is frozen there: a later read sorts and writes
    only what has come since, and numbers stay as they were.
    """
    rule = rules.get(group, topic)
    if rule is None:
        return tiers("merged").withColumn(REPLAY_OFFSET, F.col(OFFSET))
    log = tiers(rule.tier)
    if folder is None:
        return reorder(log, rule)
    frozen = ReorderedLog(log.sparkSession, f"{folder}/{group}-{topic}", rule)
    frozen.extend(log)
    return frozen.read()
