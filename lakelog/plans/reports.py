"""Reports over tier tables: counts, rates, rankings, routes and latencies."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelog.functions import bitmaps
from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.functions.scalars import hour_text, json_int, percent, percent_share
from lakelog.operators.ordering import pick_ranks
from lakelog.operators.tiers import Topic


def tier_counts(tiers: Mapping[str, DataFrame], distinct: bool = False,
                name: str = "row_count") -> DataFrame:
    """One tagged count per tier; ``distinct`` drops equal lines, as UNION does."""
    lines = [
        df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(tier).alias("source"), name)
        for tier, df in tiers.items()
    ]
    both = reduce(DataFrame.unionByName, lines)
    return both.distinct() if distinct else both


def tier_distribution(hot: DataFrame, cold: DataFrame, merged: DataFrame) -> DataFrame:
    """Counts, offset bounds and shares of the tiers under one common offset peg."""
    tops = reduce(
        DataFrame.unionByName, [df.agg(F.max(OFFSET).alias("top")) for df in (hot, cold)]
    )
    peg = tops.agg(F.max("top")).first()[0] or 0
    lines = reduce(DataFrame.unionByName, [
        df.where(F.col(OFFSET) <= peg).agg(
            F.count(F.lit(1)).alias("n"), F.min(OFFSET).alias("lo"), F.max(OFFSET).alias("hi")
        ).withColumn("tier", F.lit(tier))
        for tier, df in (("hot", hot), ("cold", cold), ("merged", merged))
    ])

    def of(tier: str, column: str) -> Column:
        return F.max(F.when(F.col("tier") == tier, F.col(column)))

    flat = lines.agg(
        of("hot", "n").alias("hot_count"), of("hot", "lo").alias("hot_earliest"),
        of("hot", "hi").alias("hot_latest"), of("cold", "n").alias("cold_count"),
        of("cold", "lo").alias("cold_earliest"), of("cold", "hi").alias("cold_latest"),
        of("merged", "n").alias("merged_count"),
    )
    return flat.select(
        F.lit(peg).cast("bigint").alias("offset_peg"), "*",
        percent_share(F.col("hot_count"), F.col("merged_count")).alias("hot_pct"),
        percent_share(F.col("cold_count"), F.col("merged_count")).alias("cold_pct"),
    )


def _slots(topic: Topic) -> DataFrame:
    """What the commits of both tiers know of each slot of offsets, in one row; no record is read."""
    sets = topic.offset_sets()
    if sets is None:
        raise ValueError(f"{topic.name} has a side that keeps no offsets: use the reports over its rows")
    own = lambda tier, column: F.when(F.col("tier") == tier, F.col(column))
    return sets.groupBy(PARTITION, bitmaps.SLOT).agg(
        F.bitmap_or_agg(bitmaps.BITMAP).alias("both"), F.min("low").alias("low"), F.max("high").alias("high"),
        *[f(own(tier, c)).alias(f"{tier}_{name}") for tier in ("hot", "cold")
          for f, c, name in ((F.sum, "rows", "count"), (F.min, "low", "earliest"), (F.max, "high", "latest"))],
    )


def stored_distribution(topic: Topic) -> DataFrame:
    """``tier_distribution`` of stored tiers from the bitmaps of their commits: a row of a slot instead of one of a record.

    All tiers are seen at one moment, so the highest offset is the peg. An offset of the log counts once in the merged count.
    """
    names = [f"{tier}_{name}" for tier in ("hot", "cold") for name in ("count", "earliest", "latest")]
    how = {"count": F.sum, "earliest": F.min, "latest": F.max}
    total = _slots(topic).agg(
        F.coalesce(F.max("high"), F.lit(0)).alias("offset_peg"), F.coalesce(F.sum(F.bitmap_count("both")), F.lit(0)).alias("merged_count"),
        *[how[n.split("_")[1]](n).alias(n) for n in names],
    ).fillna(0, ["hot_count", "cold_count"])
    return total.select(
        "offset_peg", *names, "merged_count",
        percent_share(F.col("hot_count"), F.col("merged_count")).alias("hot_pct"),
        percent_share(F.col("cold_count"), F.col("merged_count")).alias("cold_pct"),
    )


def stored_contiguity(topic: Topic) -> DataFrame:
    """Per log partition of stored tiers: bounds, records, and how many offsets between them are missing; no record is read."""
    return _slots(topic).groupBy(PARTITION).agg(
        F.min("low").alias("first_offset"), F.max("high").alias("last_offset"), F.sum(F.bitmap_count("both")).alias("records"),
        (F.max("high") - F.min("low") + 1 - F.sum(F.bitmap_count("both"))).alias("missing"),
    )


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct(key).alias("distinct_keys"),
        (F.count(F.lit(1)) == F.countDistinct(key)).alias("no_duplicates"),
    )


def grouped_count(df: DataFrame, by: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name)).orderBy(by)


def grouped_sum(df: DataFrame, by: str, value: str, name: str = "total") -> DataFrame:
    return (
        df.groupBy(by).agg(F.round(F.sum(value), 2).alias(name)).orderBy(F.desc(name), by)
    )


def envelope(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(
        F.min(x).alias("x_min"), F.max(x).alias("x_max"),
        F.min(y).alias("y_min"), F.max(y).alias("y_max"),
    )


def outcomes(stops: DataFrame, missed: str, labels: tuple[str, str]) -> DataFrame:
    """Stops per state with the label of the state, most frequent first."""
    label = F.when(F.col("state") == missed, labels[0]).otherwise(labels[1])
    return (
        stops.groupBy("state").agg(F.count(F.lit(1)).alias("stop_count"))
        .select("state", "stop_count", label.alias("label"))
        .orderBy(F.desc("stop_count"))
    )


def hit_rate(stops: DataFrame, hit: str) -> DataFrame:
    return stops.agg(percent(F.col("state") == hit).alias("purchase_pct"))


def hit_rate_by_hour(stops: DataFrame, hit: str) -> DataFrame:
    bucket = hour_text(F.col("timestamp")).alias("hour_bucket")
    return (
        stops.groupBy(bucket).agg(percent(F.col("state") == hit).alias("purchase_pct"))
        .orderBy("hour_bucket")
    )


def stops_by_hour(stops: DataFrame) -> DataFrame:
    bucket = hour_text(F.col("timestamp")).alias("hour_bucket")
    return (
        stops.groupBy(bucket)
        .agg(F.countDistinct("routeId").alias("route_count"), F.count(F.lit(1)).alias("stop_count"))
        .orderBy("hour_bucket")
    )


def latest_completed(events: DataFrame, start: str, end: str, n: int = 1) -> DataFrame:
    """The route that ended last."""
    ended = F.max(F.when(F.col("event_type") == end, F.col("timestamp")))
    return (
        events.where(F.col("event_type").isin(start, end))
        .groupBy("routeId").agg(ended.alias("end_ts"))
        .where(F.col("end_ts").isNotNull())
        .orderBy(F.desc("end_ts"), "routeId").limit(n)
    )


def leaderboard(events: DataFrame, summary: str, name: Column, path: str) -> DataFrame:
    best = (
        events.where(F.col("event_type") == summary)
        .groupBy("routeId")
        .agg(F.max(name).alias("name"), F.max(json_int(F.col("data"), path)).alias("score"))
    )
    return (
        best.where(F.col("name").isNotNull() & F.col("score").isNotNull())
        .select("name", "score").orderBy(F.desc("score"), F.asc("name"))
    )


def trajectory(positions: DataFrame, route: DataFrame) -> DataFrame:
    """Positions of the route in the one row of ``route``, in order of time."""
    return positions.join(F.broadcast(route.select("routeId").limit(1)), "routeId", "left_semi").orderBy("timestamp")


def stop_moments(stops: DataFrame, delivered: str) -> DataFrame:
    return stops.groupBy("routeId").agg(
        F.count(F.lit(1)).alias("n_stops"),
        F.sum(F.when(F.col("state") == delivered, 1).otherwise(0)).alias("n_delivered"),
    )


def position_moments(positions: DataFrame) -> DataFrame:
    return positions.groupBy("routeId").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.var_pop("x").alias("var_x"), F.var_pop("y").alias("var_y"),
    )


def route_population(stops: DataFrame, positions: DataFrame, delivered: str) -> DataFrame:
    """Aggregates over all (stop, position) pairs of a route, without forming pairs.

    Each stop meets each position of its route, so the number of pairs is a
    product, an average over stops is unchanged, and a sample deviation over
    positions follows from the population variance. Both sides shrink to one
    row per route before they are shuffled and joined.
    """
    both = stop_moments(stops, delivered).join(position_moments(positions), "routeId")
    pairs = F.col("n_stops") * F.col("n_positions")

    def deviation(var: str) -> Column:
        return F.when(pairs > 1, F.sqrt(pairs * F.col(var) / (pairs - 1)))

    return both.select(
        "routeId",
        pairs.alias("pair_count"),
        F.round(F.col("n_delivered") / F.col("n_stops"), 3).alias("delivered_share"),
        F.round(deviation("var_x") + deviation("var_y"), 6).alias("spread"),
    )


def freshness(events: DataFrame, as_of_ms: int) -> DataFrame:
    """Age of the newest event, in milliseconds, hours and days."""
    age = F.lit(as_of_ms).cast("bigint") - F.max("timestamp")
    return events.agg(age.alias("age_ms")).select(
        "age_ms",
        F.round(F.col("age_ms") / 3_600_000, 3).alias("age_hours"),
        F.round(F.col("age_ms") / 86_400_000, 3).alias("age_days"),
    )


def latency_percentiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact upper median and nearest-rank 95th percentile per group."""
    n = F.col("n")
    p95 = F.floor((n * 95 + 99) / 100) - 1
    return pick_ranks(
        df, group, value,
        {"p50": F.floor(n / 2), "p95": F.least(n - 1, p95)},
    )
