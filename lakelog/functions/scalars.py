"""Column expressions shared by reports and tests of the tiers."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD = "$field"


def sql_literal(value: Any) -> str:
    """``value`` as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply_template(template: str, operand: str) -> str:
    """SQL text of a transformer template such as ``UPPER(TRIM($field))``."""
    return template.replace(FIELD, operand)


def epoch_seconds(millis: Column) -> Column:
    """Milliseconds to whole seconds, truncated toward zero."""
    return (millis / 1000).cast("bigint")


def _moment(millis: Column) -> Column:
    """The second of an epoch-milliseconds column in UTC, whatever the session's time zone."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=epoch_seconds(millis).cast("decimal(18,6)"))


def epoch_text(millis: Column) -> Column:
    return F.date_format(_moment(millis), "yyyy-MM-dd HH:mm:ss")


def hour_text(millis: Column) -> Column:
    """Hour bucket of an epoch-milliseconds column, as text."""
    return F.date_format(_moment(millis), "yyyy-MM-dd HH:00")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def percent(matches: Column, digits: int = 2) -> Column:
    """Share of rows for which ``matches`` holds, in percent; null on no rows."""
    hits = F.sum(F.when(matches, 1).otherwise(0))
    return F.round(
        (F.lit(100.0) * hits).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), digits
    )


def json_int(text: Column, path: str) -> Column:
    return F.get_json_object(text, path).try_cast("int")


def ratio(candidate: Column, base: Column) -> Column:
    """``candidate / base``, and 0 where there is no positive base."""
    return F.when(base > 0, candidate / base).otherwise(F.lit(0.0))


def percent_change(candidate: Column, base: Column) -> Column:
    """Change against ``base`` in percent, and 0 where there is no positive base."""
    return F.when(base > 0, (candidate - base) * 100.0 / base).otherwise(F.lit(0.0))


def percent_share(part: Column, whole: Column) -> Column:
    """Whole-number percentage, with an empty whole counted as one."""
    return F.round(F.lit(100.0) * part / F.greatest(whole, F.lit(1))).cast("bigint")
