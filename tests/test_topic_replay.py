"""Replay and pages of stored tiers, by what their commits know of offsets."""

import pytest
from pyspark.sql import functions as F

from lakelog.functions import bitmaps
from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import archive, replay
from lakelog.operators.tiers import Topic
from lakelog.plans import reports
from lakelog.sources.store import Table


def sparse(spark, low, high):
    """Two partitions; one row in 1,000 in the second of four stretches of the first."""
    rows = spark.range(low, high).selectExpr("CAST(id % 2 AS INT) AS kafka_partition", "id AS kafka_offset",
                                             "CAST(NULL AS timestamp_ntz) AS kafka_timestamp", "id * 3 AS v")
    return rows.where("kafka_partition = 1 OR kafka_offset NOT BETWEEN 50000 AND 299999 OR kafka_offset % 1000 = 0")


@pytest.fixture(scope="module")
def topic(spark):
    from lakelog.sources.workdir import new_folder

    cold, hot = Table(spark, new_folder(spark, "t")), Table(spark, new_folder(spark, "t"))
    archive.archive(cold, sparse(spark, 0, 250_000).where(f"{OFFSET} NOT BETWEEN 90000 AND 95000"), 20_000)
    archive.append(cold, sparse(spark, 90_000, 93_000))  # late
    archive.archive(hot, sparse(spark, 93_000, 400_000), 20_000)
    return Topic("t", hot=hot, cold=cold, width=20_000)


def coordinates(df):
    return [(r[PARTITION], r[OFFSET]) for r in df.select(PARTITION, OFFSET).collect()]


@pytest.mark.parametrize(("start", "tasks"), [(None, None), (120_001, 5), (0, 1), (399_999, 40)])
def test_replay_is_in_order(spark, topic, start, tasks):
    found = replay.replay_topic(topic, start, tasks)
    want = coordinates(sparse(spark, start or 0, 400_000))
    assert coordinates(found) == sorted(want)
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString().lower()


def test_runs_hold_about_as_many_rows(topic):
    parts = replay.replay_topic(topic, tasks=6).groupBy(F.spark_partition_id()).count().collect()
    counts = [r["count"] for r in parts]
    assert len(counts) == 6 and max(counts) < 2.5 * sum(counts) / 6


def test_pages_over_sparse_stretches(spark, topic):
    own = sorted(o for p, o in coordinates(sparse(spark, 0, 400_000)) if p == 0)
    for position, size in ((0, 10), (49_990, 200), (60_001, 150), (93_500, 1), (299_000, 50_000), (400_000, 5)):
        got = [r[OFFSET] for r in replay.page_topic(topic, 0, position, size).collect()]
        assert got == [o for o in own if o >= position][:size]
    scan = replay.page_topic(topic, 0, 60_001, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert f"{OFFSET}#" in scan and f"< {bitmaps.end_of(bitmaps.slot_of(60_001) + 4)}" in scan


def test_other_topics_are_sorted(spark, folder):
    log = sparse(spark, 0, 300)
    plain = Topic("t", hot=log, width=100)
    assert coordinates(replay.replay_topic(plain)) == sorted(coordinates(log))
    assert coordinates(replay.page_topic(plain, 0, 5, 3)) == [(0, 6), (0, 8), (0, 10)]
    empty = Table(spark, folder)
    archive.archive(empty, log.where("FALSE"), 100)
    assert coordinates(replay.replay_topic(Topic("t", cold=empty, width=100))) == []
    assert coordinates(replay.page_topic(Topic("t", hot=log, cold=empty, width=100), 1, 0, 2)) == [(1, 1), (1, 3)]


def test_slots():
    for k in range(-70_000, 70_000, 7):
        assert k < bitmaps.end_of(bitmaps.slot_of(k)) and (bitmaps.slot_of(k) == bitmaps.slot_of(k - 1) or k == bitmaps.end_of(bitmaps.slot_of(k - 1)) or k <= 0)


def test_reports_from_bitmaps_alone(spark, topic):
    own = coordinates(sparse(spark, 0, 400_000))
    found = {r[PARTITION]: tuple(r)[1:] for r in reports.stored_contiguity(topic).collect()}
    for p in (0, 1):
        mine = [o for q, o in own if q == p]
        assert found[p] == (min(mine), max(mine), len(mine), max(mine) - min(mine) + 1 - len(mine))
    row = reports.stored_distribution(topic).first()
    hot, cold = topic.hot.read(), topic.cold.read()
    assert (row.hot_count, row.cold_count, row.merged_count) == (hot.count(), cold.count(), len(own))
    assert (row.offset_peg, row.cold_earliest, row.cold_latest, row.hot_earliest) == (399_999, 0, 249_999, 93_000)
    with pytest.raises(ValueError, match="keeps no offsets"):
        reports.stored_distribution(Topic("t", hot=hot))
