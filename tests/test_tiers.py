import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import archive, frontier
from lakelog.operators.frontier import Frontier
from lakelog.operators.tiers import Topic, drop_consecutive_duplicates, merge_tiers
from lakelog.sources.store import Table
from tests.test_store import log, values


def rows(spark, pairs):
    return spark.createDataFrame(pairs, f"{PARTITION} int, {OFFSET} bigint")


def keys(df):
    return sorted((r[PARTITION], r[OFFSET]) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_merged_has_every_row_once(spark, seed):
    rng = random.Random(seed)
    hot, cold, every = [], [], []
    for p in range(4):
        end = rng.randrange(5, 40)
        cut = rng.randrange(0, end)
        start = rng.randrange(0, cut + 1)
        every += [(p, o) for o in range(end)]
        cold += [(p, o) for o in range(cut)]
        hot += [(p, o) for o in range(start, end)]
    assert keys(merge_tiers(rows(spark, hot), rows(spark, cold))) == sorted(every)


@pytest.mark.parametrize("literal,broadcast", [(256, 1000), (0, 1000), (0, 1)])
def test_frontier_ways_agree(spark, monkeypatch, literal, broadcast):
    """Literals, broadcast and the salted shuffle split a log in the same way."""
    monkeypatch.setattr(frontier, "LITERAL_ENTRIES", literal)
    monkeypatch.setattr(frontier, "BROADCAST_ENTRIES", broadcast)
    df = rows(spark, [(p, o) for p in range(4) for o in range(10)])
    at = Frontier.of(rows(spark, [(0, 3), (1, 9), (2, 0)]))

    late = keys(at.after(df))
    assert late == [(0, o) for o in range(4, 10)] + [(2, o) for o in range(1, 10)] + [
        (3, o) for o in range(10)]
    assert sorted(late + keys(at.upto(df))) == keys(df)
    assert sorted(keys(at.at_or_after(df)) + keys(at.before(df))) == keys(df)
    assert (0, 3) in keys(at.at_or_after(df)) and (0, 3) not in late


def test_frontier_merge(spark):
    assert Frontier({0: 1, 1: 5}).merge(Frontier({1: 3, 2: 7})).entries == {0: 1, 1: 5, 2: 7}
    assert Frontier.from_json(Frontier({0: 1}).to_json()).entries == {0: 1}
    assert Frontier.of(rows(spark, [])).entries == {}


def test_archive_does_not_change_merged(spark, folder):
    cold = Table(spark, folder)
    archive.archive(cold, log(spark, 0, 300), 100)
    topic = Topic("t", hot=lambda: log(spark, 200, 700), cold=cold, width=100)
    before = keys(topic.merged())
    archive.append(cold, log(spark, 200, 600))
    assert keys(topic.merged()) == before and len(before) == 700


def test_merged_skips_live_folders_that_are_archived(spark, folder):
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    dense = F.lit(0).alias(PARTITION)  # offsets without gaps, so that the pointer tells what is archived
    archive.archive(cold, log(spark, 0, 300).withColumn(PARTITION, dense), 100)
    archive.archive(hot, log(spark, 100, 500).withColumn(PARTITION, dense), 100)
    merged = Topic("t", hot=hot, cold=cold, width=100).merged()
    assert values(merged, OFFSET) == list(range(500))
    live = [f for f in merged.inputFiles() if "/h/" in f]
    assert not any("offset_bucket=100/" in f or "offset_bucket=200/" in f for f in live)


def test_live_side_is_read_anew_for_each_query(spark, folder):
    topic = Topic("t", hot=lambda: spark.read.parquet(folder))
    log(spark, 0, 10).write.parquet(folder)
    assert topic.hot_scan().count() == 10
    log(spark, 10, 15).write.mode("append").parquet(folder)
    assert topic.hot_scan().count() == 15


def test_one_sided_and_evolved(spark):
    hot = log(spark, 5, 10).withColumn("risk", F.lit(1.0))
    cold = log(spark, 0, 7)
    assert keys(Topic("h", hot=hot).merged()) == keys(hot)
    assert keys(Topic("c", cold=cold).merged()) == keys(cold)
    both = Topic("b", hot=hot, cold=cold).merged()
    assert both.count() == 10 and both.where("risk IS NULL").count() == 7


def test_duplicate_suppression_across_windows(spark):
    """A hot route over many windows and log partitions, with runs that cross their borders."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(3), o, start + dt.timedelta(minutes=7 * (o // 2)), rng.randrange(2), None)
            for o in range(400)]
    df = spark.createDataFrame(
        data, f"route int, {PARTITION} int, {OFFSET} bigint, kafka_timestamp timestamp_ntz, x int, y int")
    last, expect = {}, []
    for route, _, o, _, x, y in sorted(data, key=lambda d: (d[3], d[1], d[2])):
        if last.get(route, ()) != (x, y):
            expect.append(o)
        last[route] = (x, y)
    for block in ("minute", "hour", "month"):
        got = drop_consecutive_duplicates(df, ["route"], ["x", "y"], block)
        assert values(got, OFFSET) == sorted(expect)


@pytest.mark.parametrize("n", [1, 30, 120, 450, 900])
def test_top_n_reads_one_end_of_the_log(spark, folder, n):
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    archive.archive(cold, log(spark, 0, 350), 100)
    archive.archive(hot, log(spark, 220, 800), 100)
    topic = Topic("t", hot=hot, cold=cold, width=100)
    assert values(topic.newest(n), OFFSET) == list(range(max(800 - n, 0), 800))
    assert values(topic.oldest(n), OFFSET) == list(range(min(n, 800)))
    whole = len(topic.merged().inputFiles())
    if n <= 30:
        assert len(topic.newest(n).inputFiles()) < whole / 3
        assert len(topic.oldest(n).inputFiles()) < whole / 3


def test_a_repeated_offset_does_not_hide_a_missing_one(spark, folder):
    """Four rows from 0 to 3, one offset twice and one missing: the folder is not complete."""
    cold, hot = Table(spark, folder + "/cold"), Table(spark, folder + "/hot")
    live = log(spark, 0, 6)
    archive.archive(hot, live, 100)
    part = live.where(f"{OFFSET} IN (0, 1, 3)")
    archive.archive(cold, part.unionByName(part.where(f"{OFFSET} = 1")), 100)
    assert archive.trim_hot(hot, cold) == 3
    assert values(hot.read(), OFFSET) == [2, 4, 5]
    archive.append(cold, live)
    assert values(cold.read(), OFFSET) == [0, 1, 1, 2, 3, 4, 5]
