"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelog.functions import scalars
from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, TIMESTAMP, block_start
from lakelog.operators import archive, cdc, replay
from lakelog.operators.frontier import Frontier
from lakelog.operators.index import OffsetIndex, granules, lookup
from lakelog.operators.membership import Membership
from lakelog.operators.tiers import Topic, drop_consecutive_duplicates, merge_tiers
from lakelog.plans import fixtures as fx
from lakelog.plans import reports
from lakelog.plans.catalog import TierCatalog
from lakelog.sources.files import Files
from lakelog.sources.log import decode_payload, stream_log
from lakelog.sources.workdir import new_folder
from lakelog.streaming import jobs
from lakelog.streaming.seeded import seeded_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-20 00:00:00"
AS_OF_MS = int(dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", PARTITION, OFFSET)
ORDER_COLUMNS = ("OrderID", "CustomerID", "Status", "Amount", PARTITION, OFFSET)
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment", OFFSET)


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.events(spark, sf_dir).merged()


# ---- scans -------------------------------------------------------------------


@query
def hot_scan(spark, sf_dir):
    return fx.events(spark, sf_dir).hot_scan().select(*EVENT_COLUMNS, TIMESTAMP, BUCKET)


@query
def cold_scan(spark, sf_dir):
    topic = fx.stored_events(spark, sf_dir)
    return topic.cold_scan().select(*EVENT_COLUMNS, TIMESTAMP)


@query
def cold_logical_scan(spark, sf_dir):
    return fx.orders(spark, sf_dir).cold_logical().select(*ORDER_COLUMNS)


@query
def merged_scan(spark, sf_dir):
    return _merged(spark, sf_dir).select(*EVENT_COLUMNS, TIMESTAMP, BUCKET)


@query
def merged_stored(spark, sf_dir):
    """The merged view over written tables, with the boundary from the pointer."""
    return fx.stored_events(spark, sf_dir).merged().select(*EVENT_COLUMNS)


@query
def cdc_deletes(spark, sf_dir):
    return fx.orders(spark, sf_dir).deletes()


def _documents(spark: SparkSession, sf_dir: str) -> Topic:
    return Topic("documents", hot=lambda: fx.table(spark, sf_dir, "documents").select(
        "doc_id", "text", "n_chars", F.lit(0).alias(PARTITION), F.col("doc_id").alias(OFFSET)))


@query
def wide_scan(spark, sf_dir):
    """All records of a live topic with large values."""
    return _documents(spark, sf_dir).hot_scan().select("doc_id", "text", "n_chars")


@query
def limit_n(spark, sf_dir):
    """Some ten records in no order: how many there are, and that each is one of the topic."""
    rows = _documents(spark, sf_dir).merged()
    some = rows.select("doc_id").limit(10)
    known = some.join(rows.select("doc_id"), "doc_id", "left_semi")
    return known.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("different"))


@query
def decode_payload_scan(spark, sf_dir):
    log = _merged(spark, sf_dir).select("event_id", "event_type", "props")
    return decode_payload(log, "props", "k INT")


@query
def merged_evolved(spark, sf_dir):
    """A column that only newer live rows carry reads as null everywhere else."""
    n = fx.events_count(spark, sf_dir)
    risk = F.when(F.col(OFFSET) >= fx.share(n, 9), F.col("value") / 10)
    topic = fx.events(spark, sf_dir)
    hot = topic.hot_scan().withColumn("risk", risk)
    rows = merge_tiers(hot, topic.cold_scan(), topic.boundary)
    return rows.select("event_id", "event_type", "value", "risk")


@query
def merged_one_sided(spark, sf_dir):
    """A topic that is only live and one that is only archived, read as merged."""
    live = Topic("supplier", hot=fx.table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("topic"), F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lit(0).alias(PARTITION), F.col("s_suppkey").alias(OFFSET)))
    kept = Topic("nation", cold=fx.table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("topic"), F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name")))
    names = ("topic", "id", "name")
    return live.merged().select(*names).unionByName(kept.merged().select(*names))


# ---- catalog -----------------------------------------------------------------


def _catalog(spark: SparkSession, sf_dir: str) -> TierCatalog:
    """Events and customers on both sides, and an empty namespace."""
    return TierCatalog(
        spark, [fx.stored_events(spark, sf_dir), fx.stored_customers(spark, sf_dir)], extra=["today"]
    ).publish()


@query
def show_namespaces(spark, sf_dir):
    """The namespaces, with the number of tables and rows in each."""
    cat = _catalog(spark, sf_dir)
    names = spark.createDataFrame([(n,) for n in cat.namespaces()], "namespace string")
    sizes = cat.inventory().groupBy("namespace").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count")
    )
    return names.join(sizes, "namespace", "left").select(
        "namespace", F.coalesce("tables", F.lit(0)).alias("tables"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


@query
def show_tables_merged(spark, sf_dir):
    return _catalog(spark, sf_dir).inventory("merged")


@query
def describe_hot(spark, sf_dir):
    """Columns of the live change log as a table: payload and coordinates, no envelope."""
    df = fx.orders(spark, sf_dir).hot_scan()
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    counts = df.agg(*[F.count(c).alias(c) for c in types])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.lit(t).alias("data_type"),
                 F.col(c).alias("non_null"))
        for c, t in types.items()
    ])))


@query
def query_in_set(spark, sf_dir):
    """One SQL text, resolved to each tier in turn."""
    cat = _catalog(spark, sf_dir)
    text = ("SELECT event_type, COUNT(*) AS n, MIN(kafka_offset) AS first_offset "
            "FROM events GROUP BY event_type")
    return reduce(DataFrame.unionByName, [
        cat.query(text, tier).select(F.lit(tier).alias("tier"), "*")
        for tier in ("hot", "cold", "merged")
    ])


def _indexed(spark, sf_dir) -> TierCatalog:
    cat = _catalog(spark, sf_dir)
    cat.add_index("customers", fx.upper_index(spark, sf_dir))
    return cat


@query
def query_in_set_indexed(spark, sf_dir):
    """SQL with a predicate on an indexed expression reads matching blocks only."""
    return _indexed(spark, sf_dir).query(
        "SELECT c_custkey, c_name, c_acctbal FROM customers WHERE UPPER(TRIM(c_name)) = 'CUSTOMER#000000042'",
        index=True,
    )


@query
def query_indexed_report(spark, sf_dir):
    """The index serves predicates that Spark moves to the table: out of a derived table, beside a join, in a list."""
    return _indexed(spark, sf_dir).query(
        """
        SELECT c.segment, n.n_regionkey, COUNT(*) AS customers, SUM(c.c_acctbal) AS balance
        FROM (SELECT UPPER(TRIM(c_name)) AS name, c_mktsegment AS segment, c_nationkey, c_acctbal FROM customers) c
        JOIN parquet.`{0}/nation.parquet` n ON n.n_nationkey = c.c_nationkey
        WHERE (c.name IN ('CUSTOMER#000000007', 'CUSTOMER#000000042') OR c.name = 'CUSTOMER#000000099')
          AND c.c_acctbal IS NOT NULL
        GROUP BY c.segment, n.n_regionkey""".format(sf_dir),
        index=True,
    )


# ---- projections and filters ---------------------------------------------------


@query
def project_rename(spark, sf_dir):
    return fx.orders(spark, sf_dir).hot_scan().select(
        "OrderID", F.col("Status").alias("hotset_status")
    )


@query
def filter_eq(spark, sf_dir):
    live = fx.orders(spark, sf_dir).hot_scan()
    return live.where(F.col("Status") == "SHIPPED").select(*ORDER_COLUMNS)


@query
def filter_range(spark, sf_dir):
    live = fx.orders(spark, sf_dir).merged()
    return live.where(F.col("OrderID") > 0).select(*ORDER_COLUMNS)


@query
def filter_transformed(spark, sf_dir):
    log = fx.customers(spark, sf_dir).merged()
    match = F.upper(F.trim("c_mktsegment")) == "BUILDING"
    return log.where(match).select(*CUSTOMER_COLUMNS)


@query
def filter_as_of(spark, sf_dir):
    """Tier counts of the rows older than a moment; ``now()`` in a live query."""
    topic = fx.events(spark, sf_dir)
    older = F.col("ts") < F.lit(AS_OF).cast("timestamp_ntz")
    tiers = {t: topic.tier(t).where(older) for t in ("hot", "cold", "merged")}
    return reports.tier_counts(tiers, distinct=True)


@query
def filter_now(spark, sf_dir):
    """Tier counts of the rows older than this moment, which here are all rows."""
    topic = fx.events(spark, sf_dir)
    older = F.col("ts") < F.current_timestamp().cast("timestamp_ntz")
    tiers = {t: topic.tier(t).where(older) for t in ("hot", "cold", "merged")}
    return reports.tier_counts(tiers, distinct=True)


@query
def drop_consecutive_dups(spark, sf_dir):
    """Positions on a coarse grid; a route that has not left its cell is not repeated."""
    log = _merged(spark, sf_dir).select(
        F.col("user_id").alias("routeId"), PARTITION, OFFSET, TIMESTAMP,
        F.floor(F.col("value") / 20).alias("x"), F.floor(F.col("value") / 40).alias("y"),
    )
    return drop_consecutive_duplicates(log, ["routeId"], ["x", "y"]).drop(TIMESTAMP)


# ---- joins -------------------------------------------------------------------


@query
def cold_hot_join(spark, sf_dir):
    """Archived status of the orders that the live log shows as shipped."""
    topic = fx.orders(spark, sf_dir)
    shipped = topic.hot_scan().where(F.col("Status") == "SHIPPED").select("OrderID")
    cold = topic.cold_scan().select("OrderID", F.col("Status").alias("coldset_status"))
    return cold.join(shipped, "OrderID")


@query
def route_population(spark, sf_dir):
    log = _merged(spark, sf_dir)
    return reports.route_population(fx.route_stops(log), fx.route_positions(log), "purchase")


@query
def route_population_preagg(spark, sf_dir):
    """The per-route moments that the population report is made of."""
    log = _merged(spark, sf_dir)
    stops = reports.stop_moments(fx.route_stops(log), "purchase")
    moments = reports.position_moments(fx.route_positions(log))
    return stops.join(moments, "routeId").select(
        "routeId", "n_stops", "n_delivered", "n_positions",
        F.round(F.sqrt("var_x"), 6).alias("dev_x"), F.round(F.sqrt("var_y"), 6).alias("dev_y"),
    )


# ---- aggregates --------------------------------------------------------------


@query
def count_all(spark, sf_dir):
    return _merged(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query
def active_sessions(spark, sf_dir):
    return _merged(spark, sf_dir).agg(F.countDistinct("user_id").alias("active_sessions"))


@query
def no_duplicates(spark, sf_dir):
    return reports.uniqueness(fx.orders(spark, sf_dir).merged(), "OrderID")


@query
def coord_envelope(spark, sf_dir):
    return reports.envelope(fx.route_positions(_merged(spark, sf_dir)), "x", "y")


@query
def event_counts(spark, sf_dir):
    return reports.grouped_count(_merged(spark, sf_dir), "event_type", "events")


@query
def outcome_counts(spark, sf_dir):
    stops = fx.route_stops(_merged(spark, sf_dir))
    return reports.outcomes(stops, "error", ("bad", "good"))


@query
def hit_rate(spark, sf_dir):
    return reports.hit_rate(fx.route_stops(_merged(spark, sf_dir)), "purchase")


@query
def hit_rate_by_hour(spark, sf_dir):
    return reports.hit_rate_by_hour(fx.route_stops(_merged(spark, sf_dir)), "purchase")


@query
def stops_by_hour(spark, sf_dir):
    return reports.stops_by_hour(fx.route_stops(_merged(spark, sf_dir)))


@query
def latest_completed(spark, sf_dir):
    return reports.latest_completed(fx.route_events(_merged(spark, sf_dir)), "signup", "purchase")


@query
def leaderboard(spark, sf_dir):
    events = fx.route_events(_merged(spark, sf_dir))
    return reports.leaderboard(events, "view", F.col("routeId").cast("string"), "$.k")


@query
def sum_by_group(spark, sf_dir):
    return reports.grouped_sum(_merged(spark, sf_dir), "event_type", "value")


@query
def status_counts(spark, sf_dir):
    rolled = cdc.read_archive(fx.rolled_orders(spark, sf_dir))
    return reports.grouped_count(rolled, "Status", "n")


@query
def tier_counts(spark, sf_dir):
    topic = fx.orders(spark, sf_dir)
    tiers = {t: topic.tier(t) for t in ("hot", "cold_physical", "merged")}
    return reports.tier_counts(tiers, name="order_count")


@query
def tier_counts_distinct(spark, sf_dir):
    topic = fx.events(spark, sf_dir)
    tiers = {t: topic.tier(t) for t in ("hot", "cold", "merged")}
    return reports.tier_counts(tiers, distinct=True)


@query
def tier_distribution(spark, sf_dir):
    topic = fx.events(spark, sf_dir)
    return reports.tier_distribution(topic.hot_scan(), topic.cold_scan(), topic.merged())


@query
def tier_distribution_stored(spark, sf_dir):
    """The same of stored tiers, from what their commits know of offsets."""
    return reports.stored_distribution(fx.stored_events(spark, sf_dir))


@query
def contiguity_stored(spark, sf_dir):
    return reports.stored_contiguity(fx.stored_events(spark, sf_dir))


@query
def freshness(spark, sf_dir):
    return reports.freshness(fx.route_events(_merged(spark, sf_dir)), AS_OF_MS)


@query
def latency_percentiles(spark, sf_dir):
    return reports.latency_percentiles(_merged(spark, sf_dir), "event_type", "value")


@query
def speed_ratio(spark, sf_dir):
    """Rows per partition of the live side against the archive; 0 without an archive."""
    topic = fx.events(spark, sf_dir)
    hot = topic.hot_scan().groupBy(PARTITION).agg(F.count(F.lit(1)).alias("candidate"))
    cold = topic.cold_scan().groupBy(PARTITION).agg(F.count(F.lit(1)).alias("base"))
    return hot.join(cold, PARTITION).select(
        PARTITION, "candidate", "base",
        F.round(scalars.ratio(F.col("candidate"), F.col("base")), 6).alias("ratio"),
        F.round(scalars.percent_change(F.col("candidate"), F.col("base")), 4).alias("change_pct"),
    )


# ---- sorts and top-k ---------------------------------------------------------


@query
def newest_n(spark, sf_dir):
    return fx.stored_events(spark, sf_dir).newest(50).select(*EVENT_COLUMNS)


@query
def oldest_n(spark, sf_dir):
    return fx.stored_events(spark, sf_dir).oldest(5).select(*EVENT_COLUMNS)


@query
def topk_key(spark, sf_dir):
    return fx.orders(spark, sf_dir).merged().select(*ORDER_COLUMNS).orderBy("OrderID").limit(10)


def _last_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_completed(spark, sf_dir).select("routeId")


@query
def trajectory(spark, sf_dir):
    positions = fx.route_positions(_merged(spark, sf_dir))
    return reports.trajectory(positions, _last_route(spark, sf_dir))


@query
def route_stops(spark, sf_dir):
    stops = fx.route_stops(_merged(spark, sf_dir))
    path = reports.trajectory(stops, _last_route(spark, sf_dir))
    delivered = path.where(F.col("state") == "purchase").withColumn("outcome", F.lit("delivered"))
    missed = path.where(F.col("state") == "error").withColumn("outcome", F.lit("undelivered"))
    return delivered.unionByName(missed)


# ---- scalar functions --------------------------------------------------------


@query
def scalar_strings(spark, sf_dir):
    return fx.customer_log(spark, sf_dir).select(
        "c_custkey", F.upper("c_name").alias("upper_name"),
        F.upper(F.trim("c_name")).alias("upper_trimmed"),
        F.substring("c_name", 1, 15).alias("prefix"),
    )


@query
def json_extract(spark, sf_dir):
    props = F.col("props")
    return _merged(spark, sf_dir).select(
        "event_id", F.get_json_object(props, "$.k").alias("k_text"),
        scalars.json_int(props, "$.k").alias("k"),
    )


@query
def epoch_convert(spark, sf_dir):
    ms = scalars.epoch_millis(F.col("ts"))
    return _merged(spark, sf_dir).select(
        "event_id", ms.alias("ms"), scalars.epoch_seconds(ms).alias("event_time"),
        scalars.epoch_text(ms).alias("event_text"), scalars.hour_text(ms).alias("hour_bucket"),
    )


@query
def offset_bucket(spark, sf_dir):
    return fx.event_log(spark, sf_dir).groupBy(PARTITION, block_start(OFFSET, 1000).alias("block")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---- change log --------------------------------------------------------------


@query
def cdc_unwrap(spark, sf_dir):
    return cdc.unwrap(fx.order_log(spark, sf_dir)).select("op", *ORDER_COLUMNS)


@query
def cdc_current(spark, sf_dir):
    return fx.orders(spark, sf_dir).hot_scan().select(*ORDER_COLUMNS)


@query
def cdc_merged(spark, sf_dir):
    return fx.orders(spark, sf_dir).merged().select(*ORDER_COLUMNS)


@query
def cdc_roll(spark, sf_dir):
    """The archive after a roll, which was run a second time without effect."""
    target = fx.order_archive(spark, sf_dir)
    hot = fx.hot_orders(spark, sf_dir)
    cdc.roll(target, hot)
    cdc.roll(target, hot)
    return cdc.read_archive(target).select(*ORDER_COLUMNS)


@query
def cdc_roll_null_key(spark, sf_dir):
    """The archive after three rolls of a log that has lost the key of some events: they are one key."""
    target = fx.order_archive(spark, sf_dir)
    hot = fx.keyless_orders(spark, sf_dir)
    for _ in range(3):
        cdc.roll(target, hot)
    return cdc.read_archive(target).select(*ORDER_COLUMNS)


@query
def cdc_merged_evolved(spark, sf_dir):
    """A payload field that only newer events carry is null for archived rows."""
    topic = Topic("orders", key="OrderID", hot=lambda: fx.evolved_orders(spark, sf_dir),
                  cold=lambda: fx.cold_orders(spark, sf_dir))
    return topic.merged().select(*ORDER_COLUMNS, "Risk")


@query
def cdc_roll_evolved(spark, sf_dir):
    """The same from the archive, which the roll gives the new column."""
    target = fx.order_archive(spark, sf_dir)
    cdc.roll(target, fx.evolved_orders(spark, sf_dir))
    topic = Topic("orders", key="OrderID", cold=target)
    return topic.merged().select(*ORDER_COLUMNS, "Risk")


@query
def cdc_roll_invariant(spark, sf_dir):
    """The merged view with the rolled archive in place of the old one."""
    after = Topic("orders", key="OrderID", hot=lambda: fx.hot_orders(spark, sf_dir),
                  cold=lambda: cdc.read_archive(fx.rolled_orders(spark, sf_dir)))
    return after.merged().select(*ORDER_COLUMNS)


# ---- archive jobs ------------------------------------------------------------


@query
def archive_ctas(spark, sf_dir):
    """The live log archived by partition and block, read back from its folders."""
    target = fx.store_hot_events(spark, sf_dir)
    return target.read().select(*EVENT_COLUMNS, BUCKET)


@query
def archive_ordered(spark, sf_dir):
    target = fx.fresh_table(spark, "ordered")
    archive.archive_ordered(target, fx.hot_events(spark, sf_dir))
    return target.read().select(*EVENT_COLUMNS, TIMESTAMP)


@query
def archive_append(spark, sf_dir):
    """The archive after two appends of the same live log: every row is there once."""
    target = fx.archive_events(spark, sf_dir)
    hot = fx.hot_events(spark, sf_dir)
    archive.append(target, hot)
    archive.append(target, hot)
    return target.read().select(*EVENT_COLUMNS)


@query
def derived_table(spark, sf_dir):
    source = fx.route_stops(fx.stored_events(spark, sf_dir).cold_scan())
    target = fx.fresh_table(spark, "derived")
    archive.derive(target, source, F.col("state") == "purchase", ["routeId", "state", "timestamp"])
    return target.read()


@query
def trim_hot(spark, sf_dir):
    hot = fx.store_hot_events(spark, sf_dir)
    archive.trim_hot(hot, fx.stored_events(spark, sf_dir).cold)
    return hot.read().select(*EVENT_COLUMNS)


@query
def trim_hot_late(spark, sf_dir):
    """Both tiers after a trim beside an archive with a gap: how often each row is there."""
    topic = fx.late_events(spark, sf_dir)
    archive.trim_hot(topic.hot, topic.cold)
    return topic.hot.read().select(*EVENT_COLUMNS).withColumn("tier", F.lit("hot")).unionByName(
        topic.cold.read().select(*EVENT_COLUMNS).withColumn("tier", F.lit("cold")))


@query
def merged_late(spark, sf_dir):
    """The merged view over an archive with a gap."""
    return fx.late_events(spark, sf_dir).merged().select(*EVENT_COLUMNS)


@query
def bloom_archive(spark, sf_dir):
    """A lookup in an archive with bloom filters, and one that they answer without reading rows."""
    target = fx.fresh_table(spark, "bloom")
    log = fx.customer_log(spark, sf_dir)
    archive.archive(target, log, max(1, fx.customer_count(spark, sf_dir)), bloom=["c_name"])
    rows = target.read()
    names = ("Customer#000000042", "Customer#000000042x")
    return reduce(DataFrame.unionByName, [
        rows.where(F.col("c_name") == name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in names
    ])


@query
def housekeeping(spark, sf_dir):
    """An archive that was written in pieces, compacted, and freed of old versions: its rows and folders."""
    target = fx.archive_events(spark, sf_dir)
    archive.append(target, fx.hot_events(spark, sf_dir))
    target.compact()
    target.vacuum(keep=1)
    leaves = target.snapshot().leaves
    crowded = len(leaves) - len({tuple(leaf.values.items()) for leaf in leaves})
    return target.read().agg(F.count("*").alias("row_count")).withColumn("crowded_folders", F.lit(crowded))


@query
def latest_data(spark, sf_dir):
    """A topic that was opened first and written to afterwards shows the rows of the moment."""
    n = fx.events_count(spark, sf_dir)
    late = F.col(OFFSET) >= fx.share(n, 9)
    hot = fx.fresh_table(spark, "growing")
    log, width = fx.hot_events(spark, sf_dir), fx.segment_width(spark, sf_dir)
    archive.archive(hot, log.where(~late), width)
    topic = Topic("events", hot=hot, cold=fx.stored_events(spark, sf_dir).cold, width=width)
    before = topic.merged().agg(F.count("*").alias("n"))
    archive.append(hot, log.where(late))
    after = topic.merged().agg(F.count("*").alias("n"))
    return before.withColumn("moment", F.lit("before")).unionByName(after.withColumn("moment", F.lit("after")))


@query
def evolve_cold(spark, sf_dir):
    """A new live column is added to the archive, and then the live log is archived."""
    n = fx.events_count(spark, sf_dir)
    risk = F.when(F.col(OFFSET) >= fx.share(n, 9), F.col("value") / 10)
    hot = fx.hot_events(spark, sf_dir).withColumn("risk", risk)
    target = fx.archive_events(spark, sf_dir)
    archive.evolve(target, hot, {"risk": "value"})
    archive.append(target, hot)
    return target.read().select("event_id", "event_type", "value", "risk", OFFSET)


# ---- index -------------------------------------------------------------------


@query
def index_build(spark, sf_dir):
    return fx.plain_index(spark, sf_dir).entries()


@query
def index_build_transformed(spark, sf_dir):
    return fx.prefix_index(spark, sf_dir).entries()


def _lookup(spark, sf_dir, value, expression, *indexes: OffsetIndex) -> DataFrame:
    found = fx.customers(spark, sf_dir).find("c_name", value, expression, indexes)
    return found.select(*CUSTOMER_COLUMNS)


@query
def index_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir, "CUSTOMER#000000042", "UPPER(TRIM($field))",
                   fx.upper_index(spark, sf_dir))


@query
def index_lookup_multi(spark, sf_dir):
    """One value of a prefix index that is in many blocks."""
    return _lookup(spark, sf_dir, "Customer#000000", "SUBSTRING($field, 1, 15)",
                   fx.prefix_index(spark, sf_dir))


@query
def index_lookup_tail(spark, sf_dir):
    """A row beyond the last indexed offset."""
    name = f"Customer#{fx.customer_count(spark, sf_dir) - 1:09d}"
    return _lookup(spark, sf_dir, name, "$field", fx.plain_index(spark, sf_dir))


@query
def index_superset(spark, sf_dir):
    """Equality on the field, served by an index on a function of it."""
    return _lookup(spark, sf_dir, "Customer#000000042", "$field", fx.prefix_index(spark, sf_dir))


@query
def index_parity(spark, sf_dir):
    """Rows with and without index, and how many are on one side only."""
    topic = fx.customers(spark, sf_dir)
    args = ("c_name", "Customer#000000", "SUBSTRING($field, 1, 15)")
    on = topic.find(*args, [fx.prefix_index(spark, sf_dir)])
    sides = on.select(OFFSET, F.lit(1).alias("side")).unionByName(
        lookup(topic.merged(), *args).select(OFFSET, F.lit(-1).alias("side")))
    return sides.groupBy(OFFSET).agg(F.sum("side").alias("d"), F.count("side").alias("n")).agg(
        F.count(F.lit(1)).alias("matches"),
        F.coalesce(F.sum(F.when(F.col("d") != 0, 1).otherwise(0)), F.lit(0)).alias("differences"),
    )


@query
def index_lookup_late(spark, sf_dir):
    """Rows archived after the index was built, below its last offset: with the index, without it,
    and with the index refreshed."""
    topic = fx.late_events(spark, sf_dir)
    args = ("event_type", "ERROR", "UPPER($field)")
    index = OffsetIndex.build(spark, new_folder(spark, "index"), topic.cold, "event_type", args[2])
    archive.append(topic.cold, topic.hot.read())
    ways = {"indexed": topic.find(*args, [index]), "plain": topic.find(*args)}
    index.refresh(topic.cold)
    ways["refreshed"] = topic.find(*args, [index])
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(way).alias("way"), *EVENT_COLUMNS) for way, rows in ways.items()
    ])


@query
def index_explain(spark, sf_dir):
    index = fx.prefix_index(spark, sf_dir)
    return index.explain(index.probe("SUBSTRING($field, 1, 15)", "Customer#000000"))


@query
def index_refresh(spark, sf_dir):
    """An index built on half of the log and then brought up to date."""
    log = fx.customer_log(spark, sf_dir)
    half = Frontier({0: fx.customer_count(spark, sf_dir) // 2})
    index = OffsetIndex.build(spark, new_folder(spark, "index"), log, "c_name",
                              "SUBSTRING($field, 1, 15)", fx.CUSTOMER_BLOCK, half)
    index.refresh(log)
    return index.entries()


@query
def index_hot_values(spark, sf_dir):
    """Blocks per indexed value: shows which values an index narrows."""
    log = fx.event_log(spark, sf_dir)
    found = granules(log, "event_type", "UPPER($field)")
    return found.groupBy("value").agg(F.count(F.lit(1)).alias("blocks"))


# ---- replay ------------------------------------------------------------------


@query
def replay_log(spark, sf_dir):
    """The whole log from the first offset, archive first and then live."""
    return replay.replay(_merged(spark, sf_dir), 0).select(*EVENT_COLUMNS)


@query
def replay_stored(spark, sf_dir):
    """The same from stored tiers, put in order by the borders of their folders."""
    return replay.replay_topic(fx.stored_events(spark, sf_dir), 0).select(*EVENT_COLUMNS)


@query
def replay_page_stored(spark, sf_dir):
    """A page across the boundary of stored tiers, its end found from the counts of their commits."""
    start = fx.share(fx.events_count(spark, sf_dir), 7) - 50
    return replay.page_topic(fx.stored_events(spark, sf_dir), 1, start, 200).select(*EVENT_COLUMNS)


@query
def replay_hot_start(spark, sf_dir):
    return replay.starts(fx.events(spark, sf_dir).hot_scan())


@query
def replay_page(spark, sf_dir):
    topic = fx.events(spark, sf_dir)
    start = fx.share(fx.events_count(spark, sf_dir), 7) - 50
    return replay.page(topic.merged(), 1, start, 200, topic.width).select(*EVENT_COLUMNS)


@query
def replay_resume(spark, sf_dir):
    """Two pages of a group: read, commit, and read on as another consumer."""
    log, width = _merged(spark, sf_dir), 1000
    progress = replay.Progress(spark, new_folder(spark, "progress"))
    pages = []
    for number in range(2):
        rows = replay.resume(log, progress, "readers", "events", 0, 150, width)
        progress.commit_page("readers", "events", rows)
        pages.append(rows.select(F.lit(number).alias("page"), *EVENT_COLUMNS))
    return pages[0].unionByName(pages[1])


@query
def virtual_topic(spark, sf_dir):
    topic = replay.VirtualTopic(
        "building-customers", fx.customers(spark, sf_dir).merged, "c_mktsegment = 'BUILDING'")
    return topic.read().select(*CUSTOMER_COLUMNS)


@query
def virtual_topic_kept(spark, sf_dir):
    """A virtual topic over stored tiers whose membership is kept: the archive at first, the live log by a refresh."""
    topic = fx.stored_events(spark, sf_dir)
    kept = Membership.build(spark, new_folder(spark, "members"), Topic("events", cold=topic.cold, width=topic.width),
                            "event_type = 'error' AND user_id % 10 = 3")
    kept.refresh(topic)
    return kept.virtual("errors", topic).read().select(*EVENT_COLUMNS)


@query
def virtual_topic_late(spark, sf_dir):
    """The same where the archive lacks a stretch; live rows, of which a part fills it, are not taken in yet."""
    topic = fx.late_events(spark, sf_dir)
    kept = Membership.build(spark, new_folder(spark, "members"), Topic("events", cold=topic.cold, width=topic.width),
                            "event_type = 'error'")
    return kept.read(topic).select(*EVENT_COLUMNS)


@query
def reordered_replay(spark, sf_dir):
    rule = replay.Rule("audit", "events", "event_type = 'error'", "ts ASC")
    numbered = replay.reorder(_merged(spark, sf_dir), rule)
    return numbered.select(replay.REPLAY_OFFSET, *EVENT_COLUMNS)


@query
def reordered_resume(spark, sf_dir):
    """A frozen re-sorted log: numbered on the archive, extended by the live log."""
    topic = fx.events(spark, sf_dir)
    rule = replay.Rule("audit", "events", "event_type = 'error'", "value DESC")
    frozen = replay.ReorderedLog(spark, new_folder(spark, "frozen"), rule)
    frozen.extend(topic.cold_scan())
    frozen.extend(topic.merged())
    return frozen.read().select(replay.REPLAY_OFFSET, *EVENT_COLUMNS)


@query
def reordered_late(spark, sf_dir):
    """A frozen order that was numbered on an archive with a gap: the rows of the gap come last."""
    topic = fx.late_events(spark, sf_dir)
    rule = replay.Rule("audit", "events", "event_type = 'error'", "value DESC")
    frozen = replay.ReorderedLog(spark, new_folder(spark, "frozen"), rule)
    frozen.extend(topic.cold_scan())
    frozen.extend(topic.merged())
    frozen.extend(topic.merged())
    return frozen.read().select(replay.REPLAY_OFFSET, *EVENT_COLUMNS)


@query
def replay_rule(spark, sf_dir):
    """The same topic read by a group with a rule and by one without."""
    book = replay.RuleBook(spark, new_folder(spark, "rules"))
    book.put(replay.Rule("audit", "events", "event_type = 'error'", "ts DESC", "cold"))
    topic, frozen = fx.events(spark, sf_dir), new_folder(spark, "frozen")
    views = [
        replay.read_as_group(group, "events", topic.tier, book, frozen).select(
            F.lit(group).alias("group_id"), replay.REPLAY_OFFSET, *EVENT_COLUMNS)
        for group in ("audit", "plain")
    ]
    return views[0].unionByName(views[1])


@query
def offset_gaps(spark, sf_dir):
    """Gaps in the offsets of each partition of the log."""
    return replay.gaps(_merged(spark, sf_dir))


@query
def offset_gaps_stored(spark, sf_dir):
    """The same of stored tiers, from the bitmaps that their commits keep."""
    return replay.gaps_topic(fx.stored_events(spark, sf_dir))


@query
def contiguity(spark, sf_dir):
    return replay.contiguity(_merged(spark, sf_dir))


@query
def batch_statistics(spark, sf_dir):
    rule = replay.Rule("audit", "events", "event_type = 'error'", "ts ASC")
    numbered = replay.reorder(_merged(spark, sf_dir), rule)
    return replay.batch_statistics(numbered, replay.REPLAY_OFFSET, 500)


# ---- streaming ---------------------------------------------------------------


def _feed(spark: SparkSession, rows: DataFrame, batches: int = 4) -> DataFrame:
    """``rows`` as a stream of so many batches, written one after the other by offset.

    A batch takes as many files as a part has, so larger logs give larger batches, not more of them.
    """
    folder = new_folder(spark, "feed")
    low, high = rows.agg(F.min(OFFSET), F.max(OFFSET)).first()
    cuts = [low + (high + 1 - low) * i // batches for i in range(batches + 1)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        part = rows.where((F.col(OFFSET) >= start) & (F.col(OFFSET) < end))
        part.write.mode("append").parquet(folder)
    files = sum(name.endswith(".parquet") for name in Files(spark).names(folder))
    return stream_log(spark, folder, rows.schema, files_per_trigger=-(-files // batches))


def _checkpoint(spark: SparkSession) -> str:
    return new_folder(spark, "stream-state")


@query
def stream_ingest(spark, sf_dir):
    rows = fx.hot_events(spark, sf_dir)
    hot = fx.fresh_table(spark, "live")
    hot.create(rows.where(F.lit(False)))
    jobs.ingest(_feed(spark, rows), hot, _checkpoint(spark))
    return hot.read().select(*EVENT_COLUMNS)


@query
def stream_archive(spark, sf_dir):
    """The live log archived batch by batch; rows that were archived before are skipped."""
    cold = fx.archive_events(spark, sf_dir)
    stream = _feed(spark, fx.hot_events(spark, sf_dir))
    jobs.archive_stream(stream, cold, _checkpoint(spark), compact_after=2)
    return cold.read().select(*EVENT_COLUMNS)


def _change_feed(spark: SparkSession, sf_dir: str):
    """A change feed, an archive, and the table for events between two rolls."""
    hot = fx.hot_orders(spark, sf_dir)
    pending = fx.fresh_table(spark, "pending")
    cdc.create_pending(pending, hot, "OrderID")
    return _feed(spark, hot), fx.order_archive(spark, sf_dir), pending


@query
def stream_cdc(spark, sf_dir):
    """A change log followed in batches; some are rolled, the last ones pending."""
    stream, target, pending = _change_feed(spark, sf_dir)
    jobs.roll_stream(stream, target, pending, _checkpoint(spark), share=10, roll_after=3)
    return cdc.state(target, pending).select(*ORDER_COLUMNS)


@query
def stream_cdc_state(spark, sf_dir):
    """The same with the newest event per key kept as stream state."""
    stream, target, pending = _change_feed(spark, sf_dir)
    jobs.latest_stream(stream, "OrderID", target, pending, _checkpoint(spark), share=10)
    return cdc.state(target, pending).select(*ORDER_COLUMNS)


@query
def stream_cdc_seeded(spark, sf_dir):
    """A change feed whose state starts from the archive, run twice: the second run finds nothing new."""
    stream, target, pending = _change_feed(spark, sf_dir)
    state = _checkpoint(spark)
    for _ in range(2):
        seeded_stream(stream, "OrderID", target, pending, state, share=10)
    return cdc.state(target, pending).select(*ORDER_COLUMNS)


@query
def stream_replay(spark, sf_dir):
    """Archive, then live log from the boundary, in one sink without a seam."""
    sink = fx.fresh_table(spark, "delivered")
    stream = _feed(spark, fx.hot_events(spark, sf_dir))
    jobs.replay_stream(spark, fx.stored_events(spark, sf_dir).cold, stream, sink,
                       _checkpoint(spark))
    return sink.read().select(*EVENT_COLUMNS)


QUERIES["decode_payload"] = QUERIES.pop("decode_payload_scan")
QUERIES["replay"] = QUERIES.pop("replay_log")
