"""Log coordinates: partition, offset, timestamp, and the block an offset is in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION = "kafka_partition"
OFFSET = "kafka_offset"
TIMESTAMP = "kafka_timestamp"
BUCKET = "offset_bucket"
COORDINATES = (PARTITION, OFFSET, TIMESTAMP)


def block_start(offset: Column | str, width: int) -> Column:
    """First offset of the block of ``width`` offsets that holds ``offset``."""
    column = F.col(offset) if isinstance(offset, str) else offset
    return (column - F.pmod(column, F.lit(width))).cast("bigint")


def with_bucket(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn(BUCKET, block_start(OFFSET, width))


def any_of(conditions: Iterable[str]) -> str:
    """SQL text of a disjunction, nested evenly so that long lists stay shallow.

    Predicates with many terms are built as text: one expression is handed to
    the session, where a tree of columns takes a call for each of its nodes.
    """
    level = [f"({c})" for c in conditions]
    if not level:
        return "FALSE"
    while len(level) > 1:
        pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
        level = [f"({' OR '.join(pair)})" if len(pair) == 2 else pair[0] for pair in pairs]
    return level[0]


def range_text(low: int | None, high: int | None = None, partition: int | None = None,
               width: int | None = None) -> str:
    """SQL text of ``low <= offset < high`` with the matching bucket predicate beside it.

    The archive is laid out by bucket, and an offset predicate alone prunes no
    directory; ``width`` is the bucket width of the table that is filtered.
    """
    terms = [] if partition is None else [f"{PARTITION} = {partition}"]
    if low is not None:
        terms.append(f"{OFFSET} >= {low}")
        if width:
            terms.append(f"{BUCKET} >= {low - low % width}")
    if high is not None:
        terms.append(f"{OFFSET} < {high}")
        if width:
            terms.append(f"{BUCKET} <= {(high - 1) - (high - 1) % width}")
    return " AND ".join(terms) or "TRUE"


def offset_range(low: int | None = None, high: int | None = None,
                 partition: int | None = None, width: int | None = None) -> Column:
    return F.expr(range_text(low, high, partition, width))
