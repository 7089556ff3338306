"""Per-partition offset frontiers: how far an archive, an index or a reader has come."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION, any_of

LITERAL_ENTRIES = 256
BROADCAST_ENTRIES = 200_000
SALTS = 64


@dataclass
class Frontier:
    """Offset per log partition; a partition that is absent has not been reached.

    How the offsets reach the rows depends on their number: as literals, by a
    broadcast, or by a salted shuffle. The result does not.
    """

    entries: dict[int, int] = field(default_factory=dict)

    @staticmethod
    def of(df: DataFrame) -> Frontier:
        """Highest offset per partition of ``df``: one partial aggregation."""
        return Frontier._fetch(df.groupBy(PARTITION).agg(F.max(OFFSET).alias("at")))

    @staticmethod
    def start_of(df: DataFrame) -> Frontier:
        return Frontier._fetch(df.groupBy(PARTITION).agg(F.min(OFFSET).alias("at")))

    @staticmethod
    def _fetch(tops: DataFrame) -> Frontier:
        # One row per log partition; the pointer of a table lists more than that.
        return Frontier({r[PARTITION]: r["at"] for r in tops.collect()})

    def after(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` beyond the frontier."""
        return self._split(df, ">", True)

    def at_or_after(self, df: DataFrame) -> DataFrame:
        return self._split(df, ">=", True)

    def upto(self, df: DataFrame) -> DataFrame:
        return self._split(df, "<=", False)

    def before(self, df: DataFrame) -> DataFrame:
        return self._split(df, "<", False)

    def condition(self, compare: str, unknown: bool) -> str:
        """The frontier as a predicate of literals, which reaches the Parquet scan."""
        if not self.entries:
            return "TRUE" if unknown else "FALSE"
        known = any_of(
            f"{PARTITION} = {p} AND {OFFSET} {compare} {at}"
            for p, at in sorted(self.entries.items())
        )
        if not unknown:
            return known
        return f"{known} OR {PARTITION} NOT IN ({', '.join(map(str, sorted(self.entries)))})"

    @property
    def is_literal(self) -> bool:
        return len(self.entries) <= LITERAL_ENTRIES

    def _split(self, df: DataFrame, compare: str, unknown: bool) -> DataFrame:
        if self.is_literal:
            return df.where(self.condition(compare, unknown))
        known = df.sparkSession.createDataFrame(
            list(self.entries.items()), "`__p` int, `__at` bigint"
        )
        if len(self.entries) <= BROADCAST_ENTRIES:
            joined = df.join(F.broadcast(known), F.col(PARTITION) == F.col("__p"), "left")
        else:
            # More log partitions than a broadcast should carry: shuffle, with the
            # rows of a busy partition spread over SALTS tasks.
            salted = known.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            salt = F.pmod(F.xxhash64(OFFSET), F.lit(SALTS)).cast("int")
            joined = df.join(
                salted, (F.col(PARTITION) == F.col("__p")) & (salt == F.col("__s")), "left"
            )
        return joined.where(f"COALESCE({OFFSET} {compare} __at, {unknown})").select(*df.columns)

    def merge(self, other: Frontier) -> Frontier:
        """The further of both frontiers, partition by partition."""
        top = dict(self.entries)
        for p, at in other.entries.items():
            top[p] = max(top.get(p, at), at)
        return Frontier(top)

    def to_json(self) -> dict[str, int]:
        return {str(p): at for p, at in self.entries.items()}

    @staticmethod
    def from_json(doc: dict[str, int] | None) -> Frontier:
        return Frontier({int(p): at for p, at in (doc or {}).items()})
