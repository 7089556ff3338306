"""Headline timings on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Beside queries over the given tables there are the three workloads of
of about 4,000,000 customers with and without index, a virtual topic of 100 members in
2,000,000 records of both tiers against the whole topic, and a re-sorted replay of about 2,000,000 records.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakelog.functions.coords import OFFSET, PARTITION, TIMESTAMP  # noqa: E402
from lakelog.operators import archive, replay  # noqa: E402
from lakelog.operators.index import OffsetIndex  # noqa: E402
from lakelog.operators.membership import Membership  # noqa: E402
from lakelog.operators.tiers import Topic  # noqa: E402
from lakelog.plans.queries import QUERIES  # noqa: E402
from lakelog.session import DEFAULTS  # noqa: E402
from lakelog.sources.store import Table  # noqa: E402
from lakelog.sources.workdir import new_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "merged_scan", "merged_stored", "count_all", "latest_completed", "leaderboard",
    "route_population", "hit_rate_by_hour", "stops_by_hour", "tier_distribution",
    "latency_percentiles", "drop_consecutive_dups", "offset_gaps", "cdc_current", "cdc_merged",
    "cdc_deletes", "cold_hot_join", "no_duplicates", "cdc_roll", "archive_ctas",
    "archive_append", "reordered_replay", "replay", "replay_page", "json_extract",
    "stream_ingest", "stream_cdc",
)
CUSTOMERS = 4_000_000
RECORDS = 2_000_000
PAGE = 50_000


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("lakelog-bench")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Small data on one machine: keep all cores busy when AQE sizes write tasks.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def best(action: Callable[[], object], runs: int = 3) -> float:
    return min(seconds(action) for _ in range(runs))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def customer_topic(spark: SparkSession) -> Topic:
    """The customer table repeated to about 4,000,000 rows, archived up to the last block."""
    base = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    n = base.count()
    copies = -(-CUSTOMERS // n)
    log = base.repartition(int(CPUS)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        F.md5(F.format_string("%d/%d", "c_custkey", "copy")).alias("Name"),
        F.format_string("%d %s street, %s", "c_nationkey", "c_mktsegment", "c_name").alias("Address"),
        F.concat(F.sha1("c_name"), F.lit("@example.org")).alias("Email"),
        F.concat(F.lit("+"), F.md5("c_name")).alias("PhoneNo"),
        "c_mktsegment",
        F.lit(0).alias(PARTITION),
        (F.col("copy") * n + F.col("c_custkey")).alias(OFFSET),
        F.lit(None).cast("timestamp_ntz").alias(TIMESTAMP),
    )
    cold = Table(spark, new_folder(spark, "bench-customers"))
    archive.archive(cold, log, 500_000)
    return Topic("customers", cold=cold, width=500_000)


def lookups(spark: SparkSession, times: dict[str, float], gates: dict[str, object]) -> None:
    topic = customer_topic(spark)
    name = hashlib.md5(b"42/31").hexdigest()
    cases = {
        "upper_trim": ("UPPER(TRIM($field))", name.upper(), "UPPER(TRIM($field))"),
        "plain": ("$field", name, "$field"),
        "substring": ("SUBSTRING($field, 1, 30)", name, "SUBSTRING($field, 1, 30)"),
        "superset": ("$field", name, "SUBSTRING($field, 1, 30)"),
    }
    indexes = {
        template: OffsetIndex.build(
            spark, new_folder(spark, "bench-index"), topic.cold_scan(), "Name", template)
        for template in sorted({t for _, _, t in cases.values()})
    }
    for case, (expression, value, template) in cases.items():
        index = indexes[template]
        full, fast = [
            lambda used=used: topic.find("Name", value, expression, used).collect()
            for used in ((), (index,))
        ]
        assert sorted(full()) == sorted(fast())
        times[f"lookup_{case}_full"] = best(full, 5)
        times[f"lookup_{case}_indexed"] = best(fast, 5)
        gates[f"lookup_{case}_speedup"] = round(
            times[f"lookup_{case}_full"] / times[f"lookup_{case}_indexed"], 2)


def virtuals(spark: SparkSession, times: dict[str, float], gates: dict[str, object]) -> None:
    """100 members of 2,000,000 records, three quarters of them archived, against the filter and the whole topic."""
    log = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    copies = -(-RECORDS // (n := log.count()))
    log = log.repartition(int(CPUS)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        "c_name", F.sha1("c_name").alias("Email"), F.md5(F.format_string("%d/%d", "c_custkey", "copy")).alias("Name"),
        F.lit(0).alias(PARTITION), (F.col("copy") * n + F.col("c_custkey") - 1).alias(OFFSET),
        F.lit(None).cast("timestamp_ntz").alias(TIMESTAMP),
    ).where(F.col(OFFSET) < RECORDS).withColumn("Class", F.when(F.col(OFFSET) % (RECORDS // 100) == 7, "rare").otherwise("common"))
    cold, hot = Table(spark, new_folder(spark, "bench-cold")), Table(spark, new_folder(spark, "bench-hot"))
    archive.archive(cold, log.where(F.col(OFFSET) < RECORDS * 3 // 4), 250_000)
    archive.archive(hot, log.where(F.col(OFFSET) >= RECORDS * 3 // 4 - 100_000), 250_000)
    topic = Topic("customers", hot=hot, cold=cold, width=250_000)
    start = time.perf_counter()
    kept = Membership.build(spark, new_folder(spark, "bench-members"), topic, "Class = 'rare'")
    times["virtual_build_2m"] = time.perf_counter() - start
    filtered = replay.VirtualTopic("rare", topic.merged, "Class = 'rare'")
    assert kept.read(topic).count() == filtered.read().count() == 100
    times["virtual_topic"] = best(lambda: drain(kept.read(topic)), 5)
    times["virtual_topic_filter"] = best(lambda: drain(filtered.read()), 5)
    times["whole_topic"] = best(lambda: drain(topic.merged()), 5)
    gates["virtual_topic_members"] = 100
    gates["virtual_topic_speedup"] = round(times["whole_topic"] / times["virtual_topic"], 2)


def replays(spark: SparkSession, times: dict[str, float], gates: dict[str, object]) -> None:
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    n = lines.count()
    copies = -(-RECORDS // n)
    log = lines.repartition(int(CPUS)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        "*", (F.col("l_orderkey") % 4).cast("int").alias(PARTITION),
        (F.col("copy") * 10_000_000_000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(OFFSET),
        F.col("l_shipdate").alias(TIMESTAMP),
    )
    cold = Table(spark, new_folder(spark, "bench-lines"))
    archive.archive_ordered(cold, log)
    rule = replay.Rule("bench", "lines")
    frozen = replay.ReorderedLog(spark, new_folder(spark, "bench-replay"), rule)
    times["replay_number_2m"] = seconds(lambda: frozen.extend(cold.read()))
    times["replay_drain_2m"] = seconds(lambda: drain(frozen.read()))
    total = n * copies
    pages, position = [], 0
    start = time.perf_counter()
    for page in frozen.pages(0, PAGE):
        rows = page.to_pandas()
        pages.append(time.perf_counter() - start)
        assert rows[replay.REPLAY_OFFSET].iloc[0] == position
        assert rows[replay.REPLAY_OFFSET].is_monotonic_increasing
        position += len(rows)
        start = time.perf_counter()
    assert position == total
    ordered = sorted(pages)
    times["replay_pages_2m"] = sum(pages)
    gates["replay_records"] = total
    gates["replay_records_per_sec"] = round(total / (times["replay_number_2m"] + times["replay_drain_2m"]))
    gates["paged_records_per_sec"] = round(total / sum(pages))
    gates["page_ms"] = {
        "avg": round(1000 * sum(pages) / len(pages), 1),
        "p50": round(1000 * ordered[len(pages) // 2], 1),
        "p95": round(1000 * ordered[min(len(pages) - 1, -(-95 * len(pages) // 100) - 1)], 1),
    }


def main() -> None:
    spark = session()
    times: dict[str, float] = {}
    gates: dict[str, object] = {}
    QUERIES["merged_scan"](spark, SF_DIR).count()  # start-up is not part of any query
    for name in HEADLINE:
        runs = 1 if name.startswith("stream_") else 2
        times[name] = best(lambda name=name: drain(QUERIES[name](spark, SF_DIR)), runs)
    lookups(spark, times, gates)
    virtuals(spark, times, gates)
    replays(spark, times, gates)
    times = {k: round(v, 4) for k, v in times.items()}
    print(json.dumps({
        "metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "gates": gates, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
