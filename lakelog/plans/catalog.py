"""Tiers as databases of the session catalog, and SQL against a chosen tier."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelog.functions.coords import COORDINATES, OFFSET, PARTITION
from lakelog.functions.scalars import FIELD
from lakelog.operators.cdc import DELETED, KEY_BUCKET
from lakelog.operators.coverage import Coverage
from lakelog.operators.index import OffsetIndex, choose
from lakelog.operators.tiers import Topic
from lakelog.plans import served
from lakelog.sources.store import Table
from lakelog.sources.workdir import new_folder

TIERS = ("hot", "cold", "merged", "deletes")


class TierCatalog:
    """Publishes topics as views ``hot.t``, ``cold.t``, ``merged.t`` and ``deletes.t``.

    Topics have to be stored: each side is a :class:`Table`. The views are plain
    SQL over the folders of the current version; ``refresh`` moves them to the
    newest one, and ``query`` does so for the tables it mentions.
    """

    def __init__(self, spark: SparkSession, topics: Iterable[Topic] = (),
                 extra: Iterable[str] = ()):
        self.spark = spark
        self.topics = {t.name: t for t in topics}
        self.extra = tuple(extra)
        self.indexes: dict[str, list[OffsetIndex]] = {}
        self._published: set[tuple[str, str]] = set()
        home = new_folder(spark, "catalog")
        for ns in (*TIERS, *self.extra):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{home}/{ns}'")

    # ---- listing -------------------------------------------------------------

    def namespaces(self) -> list[str]:
        known = {d.name for d in self.spark.catalog.listDatabases()}
        return sorted(known & {*TIERS, *self.extra})

    def tables(self, namespace: str) -> list[str]:
        """Tables of a namespace; of a tier, those that this catalog has published."""
        names = [t.name for t in self.spark.catalog.listTables(namespace) if not t.isTemporary]
        return sorted(n for n in names if namespace not in TIERS or (namespace, n) in self._published)

    def describe(self, namespace: str, name: str) -> list[tuple[str, str]]:
        schema = self.spark.table(f"{namespace}.{name}").schema
        return [(f.name, f.dataType.simpleString()) for f in schema]

    # ---- publishing ----------------------------------------------------------

    def publish(self) -> TierCatalog:
        """Create the views of all topics and drop those that this catalog made for topics it has no more."""
        for ns, name in self._published:
            if name not in self.topics:
                self.spark.sql(f"DROP VIEW IF EXISTS {ns}.`{name}`")
        self._published = {(ns, name) for ns, name in self._published if name in self.topics}
        for name in self.topics:
            self.refresh(name)
        return self

    def refresh(self, name: str) -> None:
        topic = self.topics[name]
        for ns, text in self._views(topic).items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {ns}.`{name}` AS {text}")
            self._published.add((ns, name))

    def _views(self, topic: Topic) -> dict[str, str]:
        if topic.key:
            return self._keyed_views(topic)
        hot = _select(topic.hot) if topic.hot else None
        cold = _select(topic.cold) if topic.cold else None
        views = {}
        if hot:
            views["hot"] = hot
        if cold:
            views["cold"] = cold
        views["merged"] = self._merged_text(topic) if hot and cold else hot or cold
        return views

    def _merged_text(self, topic: Topic) -> str:
        hot, cold = topic.hot.snapshot(), topic.cold.snapshot()
        fields = {f.name: f for f in [*hot.schema, *cold.schema]}
        order = [*cold.schema.names, *[n for n in hot.schema.names if n not in cold.schema.names]]

        def side(table: Table, snap) -> str:
            items = ", ".join(
                f"`{n}`" if n in snap.schema.names
                else f"CAST(NULL AS {fields[n].dataType.simpleString()}) AS `{n}`"
                for n in order
            )
            return f"SELECT {items} FROM ({table.view_sql(snap)})"

        coverage = Coverage.of(topic.cold, cold)
        archived, live = side(topic.cold, cold), side(topic.hot, hot)
        if not coverage.loose and (spans := coverage.text()):
            return f"{archived} UNION ALL {live} WHERE NOT ({spans})"
        names = ", ".join(f"h.`{n}`" for n in order)
        return (
            f"{archived} UNION ALL SELECT {names} FROM ({live}) h LEFT ANTI JOIN ({topic.cold.view_sql(cold)}) c "
            f"ON h.{PARTITION} = c.{PARTITION} AND h.{OFFSET} = c.{OFFSET}"
        )

    def _keyed_views(self, topic: Topic) -> dict[str, str]:
        key, views = topic.key, {}
        if topic.cold:
            views["cold_all"] = _select(topic.cold)
        log = topic.hot.view_sql()
        payload = topic.hot.snapshot().schema["after"].dataType.names
        coords = ", ".join(COORDINATES)
        latest = (
            f"SELECT k, TRUE AS live, e.* FROM (SELECT COALESCE(after.`{key}`, before.`{key}`) AS k, "
            f"MAX_BY(STRUCT(op, after, {coords}), {OFFSET}) AS e FROM ({log}) GROUP BY 1)"
        )
        fields = ", ".join(f"after.`{n}` AS `{n}`" for n in payload)
        views["hot"] = f"SELECT {fields}, {coords} FROM ({latest}) WHERE op <> 'd'"
        views["deletes"] = (
            f"SELECT k AS `{key}`, {PARTITION}, {OFFSET} AS delete_kafka_offset "
            f"FROM ({latest}) WHERE op = 'd'"
        )
        stored = views.pop("cold_all", None)
        if stored is None:
            views["merged"] = views["hot"]
            return views
        views["cold"] = (
            f"SELECT c.* FROM ({stored}) c LEFT ANTI JOIN ({views['deletes']}) d "
            f"ON c.`{key}` <=> d.`{key}`"
        )
        wins = (
            f"(h.live IS NOT NULL AND (c.{OFFSET} IS NULL OR c.{PARTITION} <> h.{PARTITION} "
            f"OR h.{OFFSET} >= c.{OFFSET}))"
        )
        archived = [n for n in topic.cold.snapshot().schema.names if n not in (*COORDINATES, KEY_BUCKET, DELETED)]

        def pick(n: str) -> str:
            new = f"h.after.`{n}`" if n in payload else "NULL"
            old = f"c.`{n}`" if n in archived else "NULL"
            return f"IF({wins}, {new}, {old}) AS `{n}`"

        chosen = ", ".join(
            [pick(n) for n in [*archived, *[n for n in payload if n not in archived]]]
            + [f"IF({wins}, h.{n}, c.{n}) AS {n}" for n in COORDINATES]
        )
        views["merged"] = (
            f"SELECT {chosen} FROM ({stored}) c FULL OUTER JOIN ({latest}) h "
            f"ON c.`{key}` <=> h.k WHERE NOT ({wins} AND h.op = 'd')"
        )
        return views

    # ---- querying ------------------------------------------------------------

    def add_index(self, name: str, index: OffsetIndex) -> None:
        self.indexes.setdefault(name, []).append(index)

    def query(self, sql: str, tier: str = "merged", *,
              index: bool | tuple[str, str, Any] = False) -> DataFrame:
        """Run ``sql`` with unqualified table names resolved to ``tier``.

        With ``index=True`` the tables hold only the blocks that can match, if their indexes serve what the
        query asks of them; what it asks is found in Spark's own plan of it (``served``). A tuple says it instead,
        as (table, expression over ``$field`` written with the field's name, value). Either way
        the predicates in ``sql`` decide, and tiers other than cold and merged are read whole.
        """
        mentioned = [n for n in self.topics if re.search(rf"\b{re.escape(n)}\b", sql)]
        for name in mentioned:
            self.refresh(name)
        before = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(tier)
        try:
            narrowed = {}
            if index is True:
                narrowed = self._served(sql, tier, mentioned)
            elif index:
                narrowed = {index[0]: self._narrow(tier, *index)}
            with self._standing_in(narrowed):
                return self.spark.sql(sql)
        finally:
            self.spark.catalog.setCurrentDatabase(before)

    @contextmanager
    def _standing_in(self, frames: dict[str, DataFrame]) -> Iterator[None]:
        """Temporary views in the place of tables while a text is resolved."""
        try:
            for name, frame in frames.items():
                frame.createOrReplaceTempView(name)
            yield
        finally:
            for name in frames:
                self.spark.catalog.dropTempView(name)

    def _served(self, sql: str, tier: str, mentioned: list[str]) -> dict[str, DataFrame]:
        """The indexed tables of a query that its predicates narrow. A temporary view hides a table of its name."""
        views = self.spark._jsparkSession.sessionState().catalog()
        names = [
            n for n in mentioned
            if tier in ("cold", "merged") and (tier, n) in self._published and self.indexes.get(n)
            and not self.topics[n].key and views.getTempView(n).isEmpty()
        ]
        if not names:
            return {}
        columns = {n: self.spark.table(f"{tier}.{n}").schema for n in names}
        indexes = {n: [index.pinned() for index in self.indexes[n]] for n in names}
        with self._standing_in({n: served.stand_in(self.spark, n, columns[n]) for n in names}):
            found = served.probes(self.spark, sql, indexes)
        return {
            n: self.topics[n].candidates(index, ", ".join(values), tier == "merged").select(*columns[n].names)
            for n, (index, values) in found.items()
        }

    def _narrow(self, tier: str, name: str, expression: str, value: Any) -> DataFrame:
        topic = self.topics[name]
        for index in self.indexes.get(name, []) if tier in ("cold", "merged") and not topic.key else []:
            field = index.props["field"]
            template = re.sub(rf"\b{re.escape(field)}\b", lambda _: FIELD, expression)
            best = choose(self.indexes[name], field, template)
            if best is not None:
                return topic.candidates(best, best.probe(template, value), tier == "merged")
        return self.spark.table(f"{tier}.{name}")

    def inventory(self, tier: str | None = None) -> DataFrame:
        """Listed tables with their number of rows: (namespace, table_name, row_count)."""
        parts = [
            f"SELECT '{ns}' AS namespace, '{t}' AS table_name, COUNT(*) AS row_count "
            f"FROM {ns}.`{t}`"
            for ns in ([tier] if tier else self.namespaces())
            for t in self.tables(ns)
        ]
        if not parts:
            schema = T.StructType([
                T.StructField("namespace", T.StringType()),
                T.StructField("table_name", T.StringType()),
                T.StructField("row_count", T.LongType()),
            ])
            return self.spark.createDataFrame([], schema)
        return self.spark.sql(" UNION ALL ".join(parts))


def _select(table: Table) -> str:
    snap = table.snapshot()
    names = ", ".join(f"`{n}`" for n in snap.schema.names if n not in (KEY_BUCKET, DELETED))
    hidden = f" WHERE NOT {DELETED}" if DELETED in snap.schema.names else ""
    return f"SELECT {names} FROM ({table.view_sql(snap)}){hidden}"
