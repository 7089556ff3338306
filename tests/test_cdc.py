import random

import pytest
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import cdc
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Table

PAYLOAD = "struct<OrderID:int,CustomerID:int,Status:string,Amount:double>"
SCHEMA = (f"op string, before {PAYLOAD}, after {PAYLOAD}, kafka_partition int, "
          "kafka_offset bigint, kafka_timestamp timestamp_ntz")


def event(op, key, offset, status=None):
    row = (key, key * 2, status, key * 1.5)
    return (op, None if op == "c" else row, None if op == "d" else row, key % 3, offset, None)


def change_log(spark, events):
    return spark.createDataFrame([event(*e) for e in events], SCHEMA)


def cold_rows(spark, keys):
    return spark.createDataFrame(
        [(k, k * 2, "PENDING", k * 1.5, k % 3, k, None) for k in keys],
        "OrderID int, CustomerID int, Status string, Amount double, kafka_partition int, "
        "kafka_offset bigint, kafka_timestamp timestamp_ntz")


def statuses(df):
    return {r["OrderID"]: r["Status"] for r in df.collect()}


STORY = [("c", 1, 100, "NEW"), ("u", 1, 110, "SHIPPED"), ("c", 2, 101, "NEW"), ("d", 2, 120),
         ("c", 3, 102, "NEW"), ("d", 3, 121), ("c", 3, 130, "AGAIN"), ("d", 9, 140)]


def test_current_deletes_and_recreated_key(spark):
    log = change_log(spark, STORY)
    assert statuses(cdc.current(log, "OrderID")) == {1: "SHIPPED", 3: "AGAIN"}
    gone = {r["OrderID"]: r["delete_kafka_offset"] for r in cdc.deletes(log, "OrderID").collect()}
    assert gone == {2: 120, 9: 140}


def test_unwrap_hides_the_envelope(spark):
    flat = cdc.unwrap(change_log(spark, STORY))
    assert flat.columns[:5] == ["op", "OrderID", "CustomerID", "Status", "Amount"]
    assert flat.where("op = 'd' AND OrderID IS NULL").count() == 0


def test_cold_views_and_merged(spark):
    topic = Topic("orders", key="OrderID", hot=change_log(spark, STORY),
                  cold=cold_rows(spark, [1, 2, 5]))
    assert statuses(topic.cold_scan()) == {1: "PENDING", 2: "PENDING", 5: "PENDING"}
    assert statuses(topic.cold_logical()) == {1: "PENDING", 5: "PENDING"}
    assert statuses(topic.merged()) == {1: "SHIPPED", 3: "AGAIN", 5: "PENDING"}


def test_roll_is_the_merged_state_and_idempotent(spark, folder):
    table, log = Table(spark, folder), change_log(spark, STORY)
    cdc.create_archive(table, cold_rows(spark, [1, 2, 5, 6]), "OrderID", 4)
    expect = statuses(cdc.merged(cdc.read_archive(table), log, "OrderID"))
    cdc.roll(table, log)
    assert statuses(cdc.read_archive(table)) == expect
    cdc.roll(table, log)
    assert statuses(cdc.read_archive(table)) == expect
    assert statuses(cdc.merged(cdc.read_archive(table), log, "OrderID")) == expect
    updated = cdc.read_archive(table).where("OrderID = 1").first()
    assert updated[OFFSET] == 110 and updated[PARTITION] == 1


def test_roll_rewrites_touched_buckets_only(spark, folder):
    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, range(200)), "OrderID", 16)
    before = {leaf.path for leaf in table.snapshot().leaves}
    assert cdc.roll(table, change_log(spark, [("u", 7, 999, "X")])) == 1
    assert len(before & {leaf.path for leaf in table.snapshot().leaves}) == 15
    assert cdc.roll(table, change_log(spark, []).where("false")) == 0


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_both_ways_to_roll_agree(spark, folder, monkeypatch, most):
    monkeypatch.setattr(cdc, "BROADCAST_KEYS", most)
    rng = random.Random(9)
    events = [("u", rng.randrange(60), 1000 + i, f"s{i}") for i in range(150)]
    events += [("d", rng.randrange(60), 2000 + i) for i in range(20)]
    log = change_log(spark, events)
    expect = {r["OrderID"]: tuple(r) for r in cdc.merged(
        cold_rows(spark, range(0, 80, 2)), log, "OrderID").collect()}
    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, range(0, 80, 2)), "OrderID", 4)
    for _ in range(2):
        cdc.roll(table, log)
        assert {r["OrderID"]: tuple(r) for r in cdc.read_archive(table).collect()} == expect
        rows = table.read()
        assert rows.where(F.col(cdc.KEY_BUCKET) != cdc.key_bucket("OrderID", 4)).count() == 0


def test_few_changes_do_not_shuffle_the_archive(spark, folder):
    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, range(100)), "OrderID", 4)
    state = cdc.latest(change_log(spark, STORY), "OrderID")
    kept = cdc._fold(table.read(), F.broadcast(state), "OrderID", "left")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("most", [0, 1_000_000])
@pytest.mark.parametrize("seed", range(3))
def test_pieces_in_any_order_give_the_same_state(spark, folder, monkeypatch, seed, most):
    monkeypatch.setattr(cdc, "BROADCAST_KEYS", most)
    rng = random.Random(seed)
    events, alive = [], {}
    for offset in range(1000, 1080):
        key = rng.randrange(12)
        op = "d" if alive.get(key) and rng.random() < 0.4 else "u" if alive.get(key) else "c"
        alive[key] = op != "d"
        events.append((op, key, offset, f"s{offset}"))
    whole = change_log(spark, events)
    expect = statuses(cdc.merged(cold_rows(spark, range(5)), whole, "OrderID"))
    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, range(5)), "OrderID", 4)
    pieces = [events[i:i + 20] for i in range(0, 80, 20)]
    rng.shuffle(pieces)
    for piece in pieces:
        cdc.roll(table, change_log(spark, piece), keep_deleted=True)
    assert statuses(cdc.read_archive(table)) == expect
    cdc.forget_deleted(table)
    assert table.read().where(cdc.DELETED).count() == 0
    assert statuses(cdc.read_archive(table)) == expect


def test_pending_events_count_until_they_are_folded(spark, folder):
    table, pending = Table(spark, folder + "/a"), Table(spark, folder + "/p")
    cdc.create_archive(table, cold_rows(spark, [1, 2, 5]), "OrderID", 4)
    log = change_log(spark, STORY)
    cdc.create_pending(pending, log, "OrderID")
    pending.append(cdc.newest_events(log, "OrderID"))
    expect = {1: "SHIPPED", 3: "AGAIN", 5: "PENDING"}
    assert statuses(cdc.state(table, pending)) == expect
    cdc.fold_pending(table, pending)
    assert pending.read().count() == 0
    assert statuses(cdc.read_archive(table)) == statuses(cdc.state(table, pending)) == expect


def test_hot_key_is_combined_before_the_shuffle(spark):
    """Half of all events belong to one key; one row per task leaves the map side."""
    log = change_log(spark, [("u", 1 if i % 2 else i, i, f"s{i}") for i in range(1, 200)])
    plan = cdc.latest(log, "OrderID")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert statuses(cdc.current(log, "OrderID"))[1] == "s199"
    assert cdc.current(log, "OrderID").agg(F.count("*")).first()[0] == 100


def test_new_payload_fields_reach_merged_and_the_archive(spark, folder):
    log = change_log(spark, STORY)
    log = log.withColumn("after", F.when(F.col("after").isNotNull(), F.col("after").withField("risk", F.lit(0.5))))
    topic = Topic("orders", key="OrderID", hot=log, cold=cold_rows(spark, [1, 2, 5]))
    assert {r["OrderID"]: r["risk"] for r in topic.merged().collect()} == {1: 0.5, 3: 0.5, 5: None}
    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, [1, 2, 5]), "OrderID", 4)
    cdc.roll(table, log, keep_deleted=True)
    kept = Topic("orders", key="OrderID", cold=table)
    for rows in (kept.merged(), kept.cold_scan(), kept.cold_logical() if kept.hot else kept.cold_scan()):
        assert {r["OrderID"]: r["risk"] for r in rows.collect()} == {1: 0.5, 3: 0.5, 5: None}
        assert "is_deleted" not in rows.columns


def test_null_keys_are_one_key(spark, folder):
    def lost(log):
        kept = lambda c: F.when(F.col(c).isNotNull(), F.col(c).withField("OrderID", F.lit(None).cast("int")))
        return log.withColumns({"before": kept("before"), "after": kept("after")})

    table = Table(spark, folder)
    cdc.create_archive(table, cold_rows(spark, [1, 2]), "OrderID", 2)
    log = lost(change_log(spark, [("c", 7, 100, "A"), ("u", 8, 110, "B")])).unionByName(change_log(spark, STORY))
    for _ in range(3):
        cdc.roll(table, log)
        assert sorted(r["Status"] for r in cdc.read_archive(table).collect()) == ["AGAIN", "B", "SHIPPED"]
        state = cdc.merged(cdc.read_archive(table), log, "OrderID")
        assert sorted(r["Status"] for r in state.collect()) == ["AGAIN", "B", "SHIPPED"]
    gone = lost(change_log(spark, [("d", 9, 200)]))
    assert statuses(cdc.hide_deleted(cdc.read_archive(table), cdc.deletes(gone, "OrderID"), "OrderID")) == {1: "SHIPPED", 3: "AGAIN"}
    cdc.roll(table, gone)
    assert statuses(cdc.read_archive(table)) == {1: "SHIPPED", 3: "AGAIN"}
