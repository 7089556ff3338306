"""Maintained virtual topics: the rows of a filter, whatever has been taken in, and no more read than their ranges."""

import pytest
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import archive, membership, replay
from lakelog.operators.membership import Membership
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Table
from lakelog.sources.workdir import new_folder


def orders(spark, low, high):
    """Two partitions; one row in 5,001 is of the rare kind, none between 100,000 and 299,999."""
    return spark.range(low, high).selectExpr(
        "CAST(id % 2 AS INT) AS kafka_partition", "id AS kafka_offset", "CAST(NULL AS timestamp_ntz) AS kafka_timestamp",
        "CASE WHEN id % 5001 = 7 AND id NOT BETWEEN 100000 AND 299999 THEN 'rare' WHEN id % 3 = 0 THEN 'third' ELSE 'rest' END AS kind")


@pytest.fixture(scope="module")
def topic(spark):
    cold, hot = Table(spark, new_folder(spark, "m")), Table(spark, new_folder(spark, "m"))
    archive.archive(cold, orders(spark, 0, 250_000).where(f"{OFFSET} NOT BETWEEN 60000 AND 65000"), 20_000)
    archive.archive(hot, orders(spark, 55_000, 400_000), 20_000)
    return Topic("orders", hot=hot, cold=cold, width=20_000)


def offsets(df):
    return sorted((r[PARTITION], r[OFFSET]) for r in df.select(PARTITION, OFFSET).collect())


def want(spark, high, text):
    return offsets(orders(spark, 0, high).where(text))


@pytest.mark.parametrize("kind", ["rare", "third", "none"])
def test_members_are_the_filter(spark, folder, topic, kind):
    kept = Membership.build(spark, folder, topic, f"kind = '{kind}'")
    assert offsets(kept.read(topic)) == want(spark, 400_000, f"kind = '{kind}'")
    # Both tiers are taken in, the rows that both hold once.
    assert kept.members() == len(want(spark, 400_000, f"kind = '{kind}'"))
    assert kept.refresh(topic) == 0


def test_ranges_part_at_wide_gaps_and_join_over_the_others(spark, folder, topic, monkeypatch):
    monkeypatch.setattr(membership, "MOST_RANGES", 4)
    kept = Membership.build(spark, folder, topic, "kind = 'rare'")
    ranges = kept.table.snapshot().props["ranges"]
    assert len(ranges) == 4
    # The widest gap is the stretch without members; each partition is parted there.
    assert not any(low <= 200_000 <= high for _, low, high in ranges)
    assert offsets(kept.read(topic)) == want(spark, 400_000, "kind = 'rare'")
    monkeypatch.setattr(membership, "MOST_RANGES", 1)  # fewer than partitions: the filter alone
    wide = Membership.build(spark, new_folder(spark, "m"), topic, "kind = 'rare'")
    assert wide.table.snapshot().props["ranges"] is None
    assert offsets(wide.read(topic)) == want(spark, 400_000, "kind = 'rare'")


def test_only_row_groups_and_folders_of_members_are_read(spark, folder, topic):
    kept = Membership.build(spark, folder, topic, "kind = 'rare' AND kafka_offset BETWEEN 20000 AND 49999")
    found = kept.read(topic)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "offset_bucket" in plan
    assert found.count() == 6
    assert _file_rows(found) < 60_000  # of 400,000: the folders at 20,000 and 40,000 of two partitions


def _file_rows(df):
    """Rows that the file scans of the plan gave out."""
    df.collect()
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            todo.append(node.executedPlan())
            continue
        if "QueryStageExec" in node.getClass().getName():
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_refresh_takes_in_new_commits_of_both_tiers(spark, folder):
    cold, hot = Table(spark, new_folder(spark, "m")), Table(spark, new_folder(spark, "m"))
    archive.archive(cold, orders(spark, 0, 30_000), 10_000)
    archive.archive(hot, orders(spark, 20_000, 50_000), 10_000)
    topic = Topic("orders", hot=hot, cold=cold, width=10_000)
    kept = Membership.build(spark, folder, topic, "kind = 'rare'")
    archive.append(hot, orders(spark, 50_000, 80_000))
    assert offsets(kept.read(topic)) == want(spark, 80_000, "kind = 'rare'")  # not taken in, and found
    assert kept.refresh(topic) == 1
    assert offsets(kept.read(topic)) == want(spark, 80_000, "kind = 'rare'")
    archive.append(cold, topic.hot_scan())
    assert offsets(kept.read(topic)) == want(spark, 80_000, "kind = 'rare'")
    assert kept.refresh(topic) == 1 and kept.refresh(topic) == 0
    archive.trim_hot(hot, cold)
    cold.compact()
    assert offsets(kept.read(topic)) == want(spark, 80_000, "kind = 'rare'")
    kept.refresh(topic)
    assert offsets(kept.read(topic)) == want(spark, 80_000, "kind = 'rare'")
    assert kept.members() == len(want(spark, 80_000, "kind = 'rare'"))


def test_paged_reading(spark, folder, topic):
    virtual = Membership.build(spark, folder, topic, "kind = 'rare'").virtual("rare", topic)
    got, at = [], 0
    while True:
        rows = [r[OFFSET] for r in replay.page(virtual.read(), 1, at, 7).collect()]
        if not rows:
            break
        got += rows
        at = rows[-1] + 1
    assert got == [o for p, o in want(spark, 400_000, "kind = 'rare'") if p == 1]


def test_sides_that_are_not_stored_are_filtered(spark, folder):
    cold = Table(spark, new_folder(spark, "m"))
    archive.archive(cold, orders(spark, 0, 30_000), 10_000)
    half = Topic("orders", hot=lambda: orders(spark, 20_000, 50_000), cold=cold, width=10_000)
    kept = Membership.build(spark, folder, half, "kind = 'rare'")
    assert offsets(kept.read(half)) == want(spark, 50_000, "kind = 'rare'")
    live = Topic("orders", hot=cold, width=10_000)
    alone = Membership.build(spark, new_folder(spark, "m"), live, "kind = 'rare'")
    assert offsets(alone.read(live)) == want(spark, 30_000, "kind = 'rare'")


def test_unstable_predicates_and_change_logs_are_refused(spark, folder, topic):
    with pytest.raises(ValueError, match="deterministic"):
        Membership.build(spark, folder, topic, "kafka_timestamp > current_timestamp()")
    with pytest.raises(ValueError, match="change log"):
        Membership.build(spark, folder, Topic("c", hot=topic.hot, key="id"), "TRUE")


def test_rows_without_an_offset_are_kept(spark, folder):
    rows = orders(spark, 0, 20_000).withColumn(OFFSET, F.expr(f"IF({OFFSET} = 5008, NULL, {OFFSET})"))
    cold = Table(spark, new_folder(spark, "m"))
    cold.create(rows.withColumn("offset_bucket", F.lit(0).cast("bigint")), [PARTITION, "offset_bucket"])
    topic = Topic("orders", cold=cold, width=20_000)
    kept = Membership.build(spark, folder, topic, "kind = 'rare'")
    assert kept.read(topic).count() == 4
