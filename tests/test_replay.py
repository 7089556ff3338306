import pytest
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION, TIMESTAMP
from lakelog.operators import replay
from lakelog.operators.replay import Progress, ReorderedLog, Rule, RuleBook
from lakelog.operators.tiers import Topic


def stores(spark, low, high):
    """One partition of a log with a match in every tenth row and uneven timestamps."""
    return spark.range(low, high).select(
        F.lit(0).alias(PARTITION), F.col("id").alias(OFFSET),
        F.timestamp_seconds(F.col("id") * 37 % 101).cast("timestamp_ntz").alias(TIMESTAMP),
        F.when(F.col("id") % 10 == 3, "depot").otherwise("kiosk").alias("Format"))


@pytest.fixture
def topic(spark):
    return Topic("stores", hot=lambda: stores(spark, 500, 1000), cold=lambda: stores(spark, 0, 600))


def test_replay_starts_in_the_archive(topic):
    assert replay.starts(topic.hot_scan()).first()["start_offset"] == 500
    rows = [r[OFFSET] for r in replay.replay(topic.merged()).collect()]
    assert rows == list(range(1000))
    assert [r[OFFSET] for r in replay.replay(topic.merged(), 990, 1000).collect()] == list(
        range(990, 1000))


def test_pages_are_the_whole(topic):
    log, at, seen = topic.merged(), 0, []
    while True:
        rows = [r[OFFSET] for r in replay.page(log, 0, at, 170, 1000).collect()]
        if not rows:
            break
        seen += rows
        at = rows[-1] + 1
    assert seen == list(range(1000))


def test_page_over_sparse_offsets(topic):
    matches = topic.merged().where("Format = 'depot'")
    got = [r[OFFSET] for r in replay.page(matches, 0, 5, 40).collect()]
    assert got == list(range(13, 413, 10))
    assert [r[OFFSET] for r in replay.page(matches, 0, 980, 40).collect()] == [983, 993]
    assert replay.page(matches, 0, 5000, 40).count() == 0


def test_virtual_topic_equals_client_filter_and_resumes(spark, folder, topic):
    virtual = replay.VirtualTopic("depots", topic.merged, "Format = 'depot'")
    want = [o for o in range(1000) if o % 10 == 3]
    assert sorted(r[OFFSET] for r in virtual.read().collect()) == want
    progress = Progress(spark, folder)
    first = replay.resume(virtual.read(), progress, "g", "depots", 0, 30)
    got = [r[OFFSET] for r in first.collect()]
    progress.commit_page("g", "depots", first)
    second = replay.resume(virtual.read(), progress, "g", "depots", 0, 1000)
    rest = [r[OFFSET] for r in second.collect()]
    assert got + rest == want
    assert progress.position("other", "depots") == {}


def test_virtual_topic_by_field_value(topic):
    by_value = replay.VirtualTopic("depots", topic.merged, field="Format", value="depot")
    assert by_value.read().count() == 100


def test_reordered_numbers_and_order(topic):
    rule = Rule("g", "stores", "Format = 'depot'")
    rows = replay.reorder(topic.merged(), rule).collect()
    rows.sort(key=lambda r: r[replay.REPLAY_OFFSET])
    assert [r[replay.REPLAY_OFFSET] for r in rows] == list(range(100))
    keys = [(r[TIMESTAMP], r[PARTITION], r[OFFSET]) for r in rows]
    assert keys == sorted(keys)


def test_committed_positions_survive_growth(spark, folder, topic):
    rule = Rule("g", "stores", "Format = 'depot'", "kafka_timestamp DESC")
    frozen, progress = ReorderedLog(spark, folder + "/f", rule), Progress(spark, folder + "/p")
    assert frozen.extend(stores(spark, 0, 600)) == 60
    page = frozen.resume(progress, 25)
    first = [(r[replay.REPLAY_OFFSET], r[OFFSET]) for r in page.collect()]
    assert [n for n, _ in first] == list(range(25))
    progress.commit_page("g", "stores", page, replay.REPLAY_OFFSET)
    assert frozen.extend(topic.merged()) == 100
    assert frozen.extend(topic.merged()) == 100
    again = [(r[replay.REPLAY_OFFSET], r[OFFSET]) for r in frozen.page(0, 25).collect()]
    assert again == first
    rest = [(r[replay.REPLAY_OFFSET], r[OFFSET]) for r in frozen.resume(progress, 500).collect()]
    assert [n for n, _ in rest] == list(range(25, 100))
    assert {o for _, o in first} | {o for _, o in rest} == {o for o in range(1000) if o % 10 == 3}
    assert frozen.page(100, 10).count() == 0


def test_groups_without_rule_read_the_raw_log(spark, folder, topic):
    book = RuleBook(spark, folder)
    book.put(Rule("ordered", "stores", "Format = 'depot'", tier="cold"))
    plain = replay.read_as_group("plain", "stores", topic.tier, book)
    assert plain.count() == 1000 and plain.where(f"{replay.REPLAY_OFFSET} <> {OFFSET}").count() == 0
    assert replay.read_as_group("ordered", "stores", topic.tier, book).count() == 60


def test_gaps_and_contiguity(spark):
    log = stores(spark, 0, 300).where(f"{OFFSET} NOT BETWEEN 95 AND 104 AND {OFFSET} <> 200")
    gaps = {(r["gap_start"], r["gap_end"], r["missing"]) for r in replay.gaps(log).collect()}
    assert gaps == {(95, 104, 10), (200, 200, 1)}
    row = replay.contiguity(log).first()
    assert (row["records"], row["missing"]) == (289, 11)


def test_rule_order_text():
    rule = Rule("g", "t", order_by="kafka_timestamp DESC, Format")
    assert len(rule.order()) == 4


def test_pages_ahead(spark, folder):
    frozen = ReorderedLog(spark, folder, Rule("g", "t", None, "v DESC"))
    log = spark.range(53).selectExpr("0 AS kafka_partition", "id AS kafka_offset", "id * 7 % 53 AS v",
                                     "CAST(NULL AS timestamp_ntz) AS kafka_timestamp")
    frozen.extend(log.where("kafka_offset < 30"))
    frozen.extend(log)
    for size, ahead in ((5, 2), (53, 1), (10, 9)):
        pages = [p.column(replay.REPLAY_OFFSET).to_pylist() for p in frozen.pages(3, size, ahead)]
        assert [n for page in pages for n in page] == list(range(3, 53))
        assert all(len(page) == size for page in pages[:-1])
    assert list(frozen.pages(53, 5)) == []


def test_frozen_log_without_rows(spark, folder):
    frozen = replay.ReorderedLog(spark, folder, replay.Rule("g", "t", "FALSE", "kafka_offset ASC"))
    with pytest.raises(ValueError):
        frozen.read()
    log = spark.range(5).selectExpr("0 AS kafka_partition", "id AS kafka_offset", "CAST(NULL AS timestamp_ntz) AS kafka_timestamp")
    for rows in (log.where("FALSE"), log):
        assert frozen.extend(rows) == 0
        assert frozen.read().columns == [*log.columns, replay.REPLAY_OFFSET] and frozen.read(2, 4).count() == 0


def numbered(spark, low, high):
    return spark.range(low, high).selectExpr("CAST(id % 2 AS INT) AS kafka_partition", "id AS kafka_offset", "id * 7 % 13 AS v",
                                             "CAST(NULL AS timestamp_ntz) AS kafka_timestamp")


def in_order(frozen):
    rows = sorted(frozen.read().collect(), key=lambda r: r[replay.REPLAY_OFFSET])
    assert [r[replay.REPLAY_OFFSET] for r in rows] == list(range(len(rows)))
    return [r[OFFSET] for r in rows]


def test_late_rows_get_numbers_behind_the_last(spark, folder):
    frozen = ReorderedLog(spark, folder, Rule("g", "t", "v <> 3", "v DESC"))
    early = numbered(spark, 0, 100).unionByName(numbered(spark, 200, 300))
    frozen.extend(early)
    before = in_order(frozen)
    whole = early.unionByName(numbered(spark, 100, 200)).unionByName(numbered(spark, 0, 10))  # and repeats of known rows
    assert frozen.extend(whole) == frozen.extend(whole)
    after = in_order(frozen)
    keep = lambda low, high: [k for k in range(low, high) if k * 7 % 13 != 3]
    assert after[: len(before)] == before and sorted(before) == keep(0, 100) + keep(200, 300)
    assert after[len(before) :] == sorted(keep(100, 200), key=lambda k: (-(k * 7 % 13), k % 2, k))


def test_parts_of_a_frozen_order_stay_few(spark, folder):
    frozen = ReorderedLog(spark, folder, Rule("g", "t", None, "v DESC"), most_parts=2)
    want = []
    for low in (40, 0, 20, 60, 30):
        frozen.extend(numbered(spark, low, low + 10))
        got = in_order(frozen)
        assert got[: len(want)] == want and len(got) == len(want) + 10
        want = got
        _, doc = frozen._pointer.load()
        assert len(doc["parts"]) <= 2 and len(doc["seen"]) <= 2
    assert [r[OFFSET] for r in frozen.page(15, 20).collect()] == want[15:35]
    assert replay.REPLAY_OFFSET not in numbered(spark, 0, 1).columns and frozen.read().columns[-1] == replay.REPLAY_OFFSET
