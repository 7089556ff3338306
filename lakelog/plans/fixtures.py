"""The driver's tables in the role of topics.

Each topic is derived from a whole table. ``events`` and ``customer`` are append
logs split into an archived part and a live part that overlap; ``orders`` gives
a change log: every order is created, those with status 'O' are updated, and
those of priority '5-LOW' are deleted in the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, TIMESTAMP, block_start
from lakelog.functions.scalars import epoch_millis
from lakelog.operators import archive, cdc
from lakelog.operators.frontier import Frontier
from lakelog.operators.index import OffsetIndex
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Table
from lakelog.sources.workdir import new_folder

PARTITIONS = 4
KEYS_PER_BUCKET = 1_000_000
CUSTOMER_BLOCK = 100
FOLDERS = 32
STOP_STATES = ("purchase", "error")

_made: dict = {}


def once(make: Callable) -> Callable:
    """Derive something from the immutable input tables once per application."""

    @wraps(make)
    def made(spark: SparkSession, sf_dir: str):
        key = (make.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _made:
            _made[key] = make(spark, sf_dir)
        return _made[key]

    return made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_table(spark: SparkSession, label: str) -> Table:
    return Table(spark, new_folder(spark, label))


@once
def events_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "events").count()


@once
def orders_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "orders").count()


@once
def customer_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "customer").count()


def share(count: int, tenths: int) -> int:
    """Smallest id that is not below ``tenths`` tenths of the rows."""
    return -(-count * tenths // 10)


# ---- events ------------------------------------------------------------------


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "*",
        (F.col("user_id") % PARTITIONS).cast("int").alias(PARTITION),
        F.col("event_id").alias(OFFSET),
        F.col("ts").alias(TIMESTAMP),
        block_start("event_id", 1000).alias(BUCKET),
    )


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = share(events_count(spark, sf_dir), 6)
    return event_log(spark, sf_dir).where(F.col(OFFSET) >= cut)


def cold_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = share(events_count(spark, sf_dir), 7)
    return event_log(spark, sf_dir).where(F.col(OFFSET) < cut)


@once
def events_boundary(spark: SparkSession, sf_dir: str) -> Frontier:
    return Frontier.of(cold_events(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> Topic:
    return Topic(
        "events",
        hot=lambda: hot_events(spark, sf_dir),
        cold=lambda: cold_events(spark, sf_dir),
        boundary=events_boundary(spark, sf_dir),
    )


def segment_width(spark: SparkSession, sf_dir: str) -> int:
    """Offsets per archive folder: a multiple of 1,000 that gives at most 32 blocks."""
    return 1000 * -(-events_count(spark, sf_dir) // (1000 * FOLDERS))


def window_width(spark: SparkSession, sf_dir: str) -> int:
    """Offsets per window: near the root of their number, so that both the rows in
    a window and the windows of one key stay few."""
    return 1000 * (math.isqrt(events_count(spark, sf_dir)) // 1000 + 1)


def archive_events(spark: SparkSession, sf_dir: str) -> Table:
    cold = fresh_table(spark, "cold-events")
    archive.archive(cold, cold_events(spark, sf_dir), segment_width(spark, sf_dir))
    return cold


def store_hot_events(spark: SparkSession, sf_dir: str) -> Table:
    hot = fresh_table(spark, "hot-events")
    archive.archive(hot, hot_events(spark, sf_dir), segment_width(spark, sf_dir))
    return hot


@once
def stored_events(spark: SparkSession, sf_dir: str) -> Topic:
    """The same topic as written tables, shared by the queries that only read it."""
    return Topic(
        "events",
        hot=store_hot_events(spark, sf_dir), cold=archive_events(spark, sf_dir),
        width=segment_width(spark, sf_dir),
    )


def route_events(log: DataFrame) -> DataFrame:
    """Control events of routes: routeId, epoch milliseconds, type and JSON data."""
    return log.select(
        F.col("user_id").alias("routeId"), epoch_millis(F.col("ts")).alias("timestamp"),
        "event_type", F.col("props").alias("data"), OFFSET,
    )


def route_stops(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_type").isin(*STOP_STATES)).select(
        F.col("user_id").alias("routeId"), epoch_millis(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("state"), F.col("value").alias("x"), F.col("value").alias("y"),
        OFFSET,
    )


def route_positions(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("user_id").alias("routeId"), epoch_millis(F.col("ts")).alias("timestamp"),
        F.col("value").alias("x"), F.col("value").alias("y"), OFFSET,
    )


# ---- orders ------------------------------------------------------------------


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log over all orders, from one scan."""
    n = orders_count(spark, sf_dir)
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def event(op: str, new_status, offset):
        return F.struct(
            F.lit(op).alias("op"), new_status.cast("string").alias("status"),
            offset.alias("offset"),
        )

    steps = F.array_compact(F.array(
        event("c", status, key),
        F.when(status == "O", event("u", F.lit("SHIPPED"), key + n)),
        F.when(F.col("o_orderpriority") == "5-LOW", event("d", F.lit(None), key + 2 * n)),
    ))

    def row(new_status):
        return F.struct(
            key.alias("OrderID"), F.col("o_custkey").alias("CustomerID"),
            new_status.alias("Status"), F.col("o_totalprice").alias("Amount"),
        )

    op = F.col("e.op")
    return (
        table(spark, sf_dir, "orders").withColumn("e", F.explode(steps))
        .select(
            op.alias("op"),
            F.when(op != "c", row(status)).alias("before"),
            F.when(op != "d", row(F.col("e.status"))).alias("after"),
            (key % PARTITIONS).cast("int").alias(PARTITION),
            F.col("e.offset").alias(OFFSET),
            F.col("o_orderdate").alias(TIMESTAMP),
        )
    )


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_log(spark, sf_dir).where(F.col(OFFSET) * 3 >= orders_count(spark, sf_dir))


def keyless_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live change log, every seventh key lost in all events but deletes."""
    log = hot_orders(spark, sf_dir)
    lost = (F.col("op") != "d") & (F.coalesce("after.OrderID", "before.OrderID") % 7 == 0)

    def without(name: str):
        kept = F.col(name).withField("OrderID", F.when(~lost, F.col(f"{name}.OrderID")))
        return F.when(F.col(name).isNotNull(), kept)

    return log.withColumns({"after": without("after"), "before": without("before")})


def cold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The creates of the first third, archived before any update."""
    log = table(spark, sf_dir, "orders").where(
        F.col("o_orderkey") * 3 < orders_count(spark, sf_dir)
    )
    return log.select(
        F.col("o_orderkey").alias("OrderID"), F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderstatus").alias("Status"), F.col("o_totalprice").alias("Amount"),
        (F.col("o_orderkey") % PARTITIONS).cast("int").alias(PARTITION),
        F.col("o_orderkey").alias(OFFSET), F.col("o_orderdate").alias(TIMESTAMP),
    )


def orders(spark: SparkSession, sf_dir: str) -> Topic:
    return Topic(
        "orders", key="OrderID",
        hot=lambda: hot_orders(spark, sf_dir), cold=lambda: cold_orders(spark, sf_dir),
    )


def order_archive(spark: SparkSession, sf_dir: str) -> Table:
    target = fresh_table(spark, "cold-orders")
    buckets = max(8, orders_count(spark, sf_dir) // KEYS_PER_BUCKET)
    cdc.create_archive(target, cold_orders(spark, sf_dir), "OrderID", buckets)
    return target


@once
def rolled_orders(spark: SparkSession, sf_dir: str) -> Table:
    target = order_archive(spark, sf_dir)
    cdc.roll(target, hot_orders(spark, sf_dir))
    return target


# ---- customers ---------------------------------------------------------------


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "*",
        F.lit(0).alias(PARTITION),
        F.col("c_custkey").alias(OFFSET),
        F.lit(None).cast("timestamp_ntz").alias(TIMESTAMP),
    )


@once
def customers(spark: SparkSession, sf_dir: str) -> Topic:
    """Nine tenths archived, the last fifth live."""
    n = customer_count(spark, sf_dir)
    width = CUSTOMER_BLOCK * -(-n // (CUSTOMER_BLOCK * FOLDERS))
    log = customer_log(spark, sf_dir)
    cold = fresh_table(spark, "cold-customers")
    archive.archive(cold, log.where(F.col(OFFSET) < share(n, 9)), width)
    return Topic(
        "customers", cold=cold, width=width,
        hot=lambda: customer_log(spark, sf_dir).where(F.col(OFFSET) >= share(n, 8)),
    )


@once
def stored_customers(spark: SparkSession, sf_dir: str) -> Topic:
    """The same topic with a stored live side."""
    topic = customers(spark, sf_dir)
    hot = fresh_table(spark, "hot-customers")
    archive.archive(hot, topic.hot(), topic.width)
    return Topic("customers", hot=hot, cold=topic.cold, width=topic.width)


def late_events(spark: SparkSession, sf_dir: str) -> Topic:
    """An archive that lacks a stretch in its middle, beside a live log that has it."""
    n = events_count(spark, sf_dir)
    gap = (F.col(OFFSET) >= share(n, 3)) & (F.col(OFFSET) < share(n, 5))
    cold, hot = fresh_table(spark, "gap-cold"), fresh_table(spark, "gap-hot")
    width = segment_width(spark, sf_dir)
    archive.archive(cold, cold_events(spark, sf_dir).where(~gap), width)
    archive.archive(hot, event_log(spark, sf_dir).where(F.col(OFFSET) >= share(n, 2)), width)
    return Topic("events", hot=hot, cold=cold, width=width)


def evolved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live change log with a payload field that the archive does not have."""
    log = hot_orders(spark, sf_dir)
    risk = F.when(F.col("after").isNotNull(), F.col("after.Amount") / 10)
    return log.withColumn("after", F.when(F.col("after").isNotNull(), F.col("after").withField("Risk", risk)))


def _index(spark: SparkSession, sf_dir: str, template: str) -> OffsetIndex:
    topic = customers(spark, sf_dir)
    return OffsetIndex.build(
        spark, new_folder(spark, "index"), topic.cold, "c_name", template,
        CUSTOMER_BLOCK, Frontier(topic.cold.snapshot().frontier()),
    )


@once
def plain_index(spark: SparkSession, sf_dir: str) -> OffsetIndex:
    return _index(spark, sf_dir, "$field")


@once
def upper_index(spark: SparkSession, sf_dir: str) -> OffsetIndex:
    return _index(spark, sf_dir, "UPPER(TRIM($field))")


@once
def prefix_index(spark: SparkSession, sf_dir: str) -> OffsetIndex:
    return _index(spark, sf_dir, "SUBSTRING($field, 1, 15)")
