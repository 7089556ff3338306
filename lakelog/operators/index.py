"""Offset-granule index: which blocks of offsets hold a value.

An index maps the value of a field, or of a template over it such as
``UPPER(TRIM($field))``, to blocks of offsets. A lookup reads those blocks and
the offsets that came after the index was built, and applies the predicate again.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, any_of, block_start, range_text
from lakelog.functions.scalars import FIELD, apply_template, sql_literal
from lakelog.operators.frontier import Frontier
from lakelog.operators.ordering import range_tasks
from lakelog.sources.store import Snapshot, Table

LITERAL_GRANULES = 512
BROADCAST_GRANULES = 1_000_000
VALUE, GRANULE = "value", "granule"

# Fixed: functions whose result is not a function of the field alone.
_UNSTABLE = (
    "rand", "randn", "random", "uuid", "shuffle", "now", "current_date",
    "current_timestamp", "monotonically_increasing_id", "spark_partition_id",
    "input_file_name",
)


def require_stable(text: str, what: str) -> None:
    """Refuse SQL text whose value can change while the row does not."""
    if re.search(r"\b(" + "|".join(_UNSTABLE) + r")\b", text, re.IGNORECASE):
        raise ValueError(f"{what} needs a deterministic expression: {text}")


def granules(log: DataFrame, field: str, template: str = FIELD, width: int = 1000) -> DataFrame:
    """Distinct (value, partition, block); nulls never match an equality and stay out."""
    value = F.expr(apply_template(template, f"`{field}`"))
    return (
        log.select(value.alias(VALUE), PARTITION, block_start(OFFSET, width).alias(GRANULE))
        .where(F.col(VALUE).isNotNull())
        .distinct()
    )


class OffsetIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.table = Table(spark, path)

    @staticmethod
    def build(spark: SparkSession, path: str, log: DataFrame | Table, field: str,
              template: str = FIELD, width: int = 1000,
              upto: Frontier | None = None) -> OffsetIndex:
        """Index ``log`` up to ``upto`` (default: all of it).

        Of a table the index also keeps the commits it has seen, so rows that are added
        later are found and taken in whatever their offsets. Of a frame it knows the
        offsets only: rows that come late below them are not seen. Entries are sorted by value, so that a probe reads a few row groups.
        """
        require_stable(template, "an index")
        if FIELD not in template:
            raise ValueError(f"the template has to use {FIELD}: {template}")
        index = OffsetIndex(spark, path)
        commits = None
        if isinstance(log, Table):
            snap = log.snapshot()
            log, commits = log.read(snap), sorted({leaf.commit for leaf in snap.leaves})
        reached = upto or Frontier.of(log)
        entries = granules(reached.upto(log), field, template, width)
        index.table.create(
            _by_value(entries), ranged=True,
            props={"field": field, "template": template, "width": width,
                   "reached": reached.to_json(), "commits": commits},
        )
        return index

    @property
    def props(self) -> dict[str, Any]:
        return self.table.snapshot().props

    def pinned(self) -> Pinned:
        """The index as it is now, for one lookup."""
        return Pinned(self.table, self.table.snapshot())

    def reached(self) -> Frontier:
        return self.pinned().reached

    def refresh(self, log: DataFrame | Table) -> int:
        """Index what came since, and return in how many log partitions.

        Only new offsets of a frame are read, and only new commits of a table.
        """
        base = self.table.snapshot()
        props = base.props
        old, commits = Frontier.from_json(props["reached"]), props.get("commits")
        if isinstance(log, Table):
            if commits is None:
                raise ValueError("this index was built from a frame and does not know commits")
            snap = log.snapshot()
            late = Pinned(self.table, base).unindexed(snap)
            if not late:
                return 0
            fresh = log.read(snap, lambda leaf: leaf.commit in late)
            commits = sorted({leaf.commit for leaf in snap.leaves})
        else:
            fresh = old.after(log)
        new = Frontier.of(fresh)
        if not new.entries:
            return 0
        entries = granules(new.upto(fresh), props["field"], props["template"], props["width"])
        self.table.append(_by_value(entries), ranged=True, base=base,
                          props={"reached": old.merge(new).to_json(), "commits": commits})
        return len(new.entries)

    def entries(self) -> DataFrame:
        # A block that was indexed in two parts has an entry in each.
        return self.table.read().distinct()

    def serves(self, field: str, expression: str) -> int:
        return self.pinned().serves(field, expression)

    def probe(self, expression: str, value: Any) -> str:
        return self.pinned().probe(expression, value)

    def blocks(self, probe: str) -> DataFrame:
        return self.pinned().blocks(probe)

    def prune(self, log: DataFrame, probe: str, bucket_width: int | None = None,
              partitions: Iterable[int] | None = None) -> DataFrame:
        return self.pinned().prune(log, probe, bucket_width, partitions)

    def explain(self, probe: str) -> DataFrame:
        return self.pinned().explain(probe)


@dataclass
class Pinned:
    """One version of an index: what a lookup asks for, all from the same snapshot."""

    table: Table
    snap: Snapshot

    @property
    def reached(self) -> Frontier:
        return Frontier.from_json(self.snap.props["reached"])

    def unindexed(self, snap: Snapshot) -> set[str]:
        """Commits of a table that the index has not seen; none if it was built from a frame."""
        known = self.snap.props.get("commits")
        return set() if known is None else {leaf.commit for leaf in snap.leaves} - set(known)

    def serves(self, field: str, expression: str) -> int:
        """2: indexed as written; 1: equality on the field implies one on the index."""
        props = self.snap.props
        if props["field"] != field:
            return 0
        if _plain(props["template"]) == _plain(expression):
            return 2
        return 1 if expression == FIELD else 0

    def probe(self, expression: str, value: Any) -> str:
        """SQL text of the index value to look for."""
        template = self.snap.props["template"]
        if _plain(template) == _plain(expression):
            return sql_literal(value)
        return apply_template(template, sql_literal(value))

    def blocks(self, probe: str) -> DataFrame:
        """Blocks of a value; ``probe`` may list several with commas."""
        hits = self.table.read(self.snap).where(f"{VALUE} IN ({probe})")
        return hits.select(PARTITION, GRANULE)

    def blind(self, probe: str) -> bool:
        """Whether the probe is null, as of a template that makes null of a value: the index holds no nulls."""
        if "(" not in probe:  # a literal, or several
            return False
        return self.table.spark.sql(f"SELECT EXISTS(ARRAY({probe}), x -> x IS NULL) AS n").first()["n"]

    def prune(self, log: DataFrame, probe: str, bucket_width: int | None = None,
              partitions: Iterable[int] | None = None) -> DataFrame:
        """Rows of ``log`` in matching blocks or in the tail: a superset of the matches.

        A few blocks become literal ranges, which prune folders and row groups.
        More become a broadcast semi join, after a check of their number. Beyond
        that the value is everywhere, and the whole log is read.
        ``partitions`` names all log partitions that ``log`` has, if that is known.
        """
        if self.blind(probe):
            return log
        width, reached = self.snap.props["width"], self.reached
        found = self.blocks(probe)
        # Sorted, so that one job finds them all; each task keeps no more than the limit.
        few = found.orderBy(PARTITION, GRANULE).limit(LITERAL_GRANULES + 1).collect()
        if bucket_width is None or BUCKET not in log.columns:
            bucket_width = None
        if len(few) <= LITERAL_GRANULES and reached.is_literal:
            starts = dict.fromkeys((r[PARTITION], r[GRANULE]) for r in few)
            spans = [(p, low, low + width) for p, low in starts]
            tails = [(p, at, None) for p, at in sorted(reached.entries.items())]
            hit = any_of(range_text(low, high, p, bucket_width) for p, low, high in [*spans, *tails])
            if partitions is not None and set(partitions) <= set(reached.entries):
                # Offsets alone, so that the row groups inside a folder are pruned too:
                # a condition that mixes folder columns in does not reach them.
                tail = min((at for _, at, _ in tails), default=0)
                blocks = sorted({(low, high) for _, low, high in spans if low < tail})
                inside = any_of(range_text(*span) for span in [*_joined(blocks), (tail, None)])
                return log.where(f"{hit} AND {inside}")
            others = ", ".join(map(str, sorted(reached.entries)))
            return log.where(f"{hit} OR {PARTITION} NOT IN ({others})" if others else "TRUE")
        if found.limit(BROADCAST_GRANULES + 1).count() > BROADCAST_GRANULES:
            return log
        body = reached.before(log).withColumn("__g", block_start(OFFSET, width))
        on = ["__p", "__g"]
        blocks = found.distinct().select(F.col(PARTITION).alias("__p"), F.col(GRANULE).alias("__g"))
        body = body.withColumn("__p", F.col(PARTITION))
        if bucket_width and bucket_width % width == 0:
            blocks = blocks.withColumn("__b", block_start("__g", bucket_width))
            body = body.withColumn("__b", F.col(BUCKET))
            on.append("__b")
        hits = body.join(F.broadcast(blocks), on, "left_semi").select(*log.columns)
        return hits.unionByName(reached.at_or_after(log))

    def explain(self, probe: str) -> DataFrame:
        """The offset ranges that a lookup reads; an open end is the unindexed tail, from 0 if the index cannot tell."""
        width, blind = self.snap.props["width"], self.blind(probe)
        ranges = self.blocks(probe).distinct().select(
            PARTITION, F.col(GRANULE).alias("low"), (F.col(GRANULE) + width).alias("high")
        )
        tails = self.table.spark.createDataFrame(
            [(p, 0 if blind else at, None) for p, at in sorted(self.reached.entries.items())],
            f"{PARTITION} int, low bigint, high bigint",
        )
        return ranges.unionByName(tails)


def _by_value(entries: DataFrame) -> DataFrame:
    order = [F.col(VALUE), F.col(PARTITION), F.col(GRANULE)]
    return entries.repartitionByRange(range_tasks(entries), *order).sortWithinPartitions(*order)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch made one."""
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _plain(template: str) -> str:
    return re.sub(r"\s+", "", template).lower()


def predicate(field: str, value: Any, expression: str = FIELD) -> Column:
    return F.expr(f"{apply_template(expression, f'`{field}`')} = {sql_literal(value)}")


def choose(indexes: Iterable[OffsetIndex], field: str, expression: str) -> Pinned | None:
    """The best index for ``expression = value``, or none."""
    pinned = [index.pinned() for index in indexes]
    ranked = [(index.serves(field, expression), index) for index in pinned]
    best = max(ranked, key=lambda pair: pair[0], default=(0, None))
    return best[1] if best[0] else None


def lookup(log: DataFrame, field: str, value: Any, expression: str = FIELD,
           indexes: Iterable[OffsetIndex] = (), bucket_width: int | None = None,
           partitions: Iterable[int] | None = None) -> DataFrame:
    """``log`` where ``expression`` over ``field`` equals ``value``, by index if one serves."""
    match = predicate(field, value, expression)
    index = choose(indexes, field, expression)
    if index is None:
        return log.where(match)
    probe = index.probe(expression, value)
    return index.prune(log, probe, bucket_width, partitions).where(match)


def effective_predicate(index: OffsetIndex, field: str, value: Any,
                        expression: str = FIELD) -> dict[str, str]:
    """The predicate as written and with the blocks it is narrowed to, as text.

    Blocks that touch are one range. The text is for people: it has a term for each range.
    """
    original = f"{apply_template(expression, field)} = {sql_literal(value)}"
    spans: dict[int, list[tuple[int, int]]] = {}
    tails = []
    for r in index.explain(index.probe(expression, value)).collect():
        if r["high"] is None:
            tails.append(f"({PARTITION} = {r[PARTITION]} AND {OFFSET} >= {r['low']})")
        else:
            spans.setdefault(r[PARTITION], []).append((r["low"], r["high"]))
    parts = [
        f"({PARTITION} = {p} AND {OFFSET} >= {low} AND {OFFSET} < {high})"
        for p, own in sorted(spans.items()) for low, high in _joined(sorted(own))
    ]
    return {"original": original, "effective": f"({' OR '.join(parts + sorted(tails))}) AND {original}"}
