from pyspark.sql import functions as F

from lakelog.functions.coords import BUCKET, OFFSET
from lakelog.operators import archive, cdc
from lakelog.plans import fixtures as fx
from lakelog.plans.queries import _feed
from lakelog.sources.log import decode_payload, read_log, stream_log
from lakelog.sources.store import Table
from lakelog.streaming import jobs
from lakelog.streaming.seeded import seeded_stream
from tests.test_cdc import SCHEMA, change_log, cold_rows, statuses
from tests.test_store import log, values


def feed(spark, folder, frames):
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)
    return lambda: stream_log(spark, folder, frames[0].schema, files_per_trigger=1)


def test_ingest_resumes_without_duplicates(spark, folder):
    hot = Table(spark, folder + "/hot")
    hot.create(log(spark, 0, 0))
    src = folder + "/src"
    stream = feed(spark, src, [log(spark, 0, 10), log(spark, 10, 20)])
    jobs.ingest(stream(), hot, folder + "/ck")
    assert values(hot.read(), OFFSET) == list(range(20))
    log(spark, 20, 25).coalesce(1).write.mode("append").parquet(src)
    jobs.ingest(stream(), hot, folder + "/ck")
    jobs.ingest(stream(), hot, folder + "/ck")
    assert values(hot.read(), OFFSET) == list(range(25))


def test_archive_takes_files_in_any_order(spark, folder):
    cold = Table(spark, folder + "/cold")
    archive.archive(cold, log(spark, 0, 50), 100)
    stream = feed(spark, folder + "/src",
                  [log(spark, 150, 200), log(spark, 30, 90), log(spark, 90, 150)])
    jobs.archive_stream(stream(), cold, folder + "/ck", compact_after=2)
    assert values(cold.read(), OFFSET) == list(range(200))


def test_replay_crosses_the_boundary_once(spark, folder):
    cold, sink = Table(spark, folder + "/cold"), Table(spark, folder + "/sink")
    archive.archive(cold, log(spark, 0, 100), 100)
    stream = feed(spark, folder + "/src", [log(spark, 60, 130), log(spark, 130, 160)])
    jobs.replay_stream(spark, cold, stream(), sink, folder + "/ck")
    archive.append(cold, log(spark, 100, 160))
    jobs.replay_stream(spark, cold, stream(), sink, folder + "/ck")
    assert values(sink.read(), OFFSET) == list(range(160))


def test_replay_fills_the_gaps_of_the_archive(spark, folder, sf_dir):
    topic, sink = fx.late_events(spark, sf_dir), Table(spark, folder + "/sink")
    live = topic.hot_scan().drop(BUCKET)
    want = values(topic.merged(), OFFSET)
    halves = [live.where(F.col(OFFSET) % 2 == k) for k in (0, 1)]
    stream = feed(spark, folder + "/src", halves)
    jobs.replay_stream(spark, topic.cold, stream(), sink, folder + "/ck")
    archive.append(topic.cold, live)
    jobs.replay_stream(spark, topic.cold, stream(), sink, folder + "/ck")
    assert values(sink.read(), OFFSET) == want == list(range(fx.events_count(spark, sf_dir)))


EVENTS = [
    [("c", 1, 100, "NEW"), ("c", 2, 101, "NEW"), ("c", 3, 102, "NEW")],
    [("u", 1, 110, "SHIPPED"), ("d", 2, 120), ("d", 7, 125)],
    [("d", 3, 121), ("c", 3, 130, "AGAIN")],
]
STATE = {1: "SHIPPED", 3: "AGAIN", 8: "PENDING"}


def _tables(spark, folder):
    table, pending = Table(spark, folder + "/a"), Table(spark, folder + "/p")
    cdc.create_archive(table, cold_rows(spark, [7, 8]), "OrderID", 4)
    cdc.create_pending(pending, spark.createDataFrame([], SCHEMA), "OrderID")
    return table, pending


def test_change_feed_out_of_order(spark, folder):
    for name, order in (("x", (0, 1, 2)), ("y", (2, 1, 0))):
        table, pending = _tables(spark, f"{folder}/{name}")
        stream = feed(spark, f"{folder}/{name}/src", [change_log(spark, EVENTS[i]) for i in order])
        jobs.roll_stream(stream(), table, pending, f"{folder}/{name}/ck", roll_after=2)
        assert statuses(cdc.state(table, pending)) == STATE
        cdc.fold_pending(table, pending)
        assert statuses(cdc.read_archive(table)) == STATE


def test_change_feed_with_state_store(spark, folder):
    table, pending = _tables(spark, folder)
    stream = feed(spark, folder + "/src", [change_log(spark, EVENTS[i]) for i in (1, 2, 0)])
    jobs.latest_stream(stream(), "OrderID", table, pending, folder + "/ck")
    assert statuses(cdc.state(table, pending)) == STATE


def test_new_field_appears_without_declaration(spark, folder):
    log(spark, 0, 5).write.mode("append").parquet(folder)
    log(spark, 5, 8).withColumn("risk", F.lit(0.1)).write.mode("append").parquet(folder)
    both = read_log(spark, folder)
    assert both.where("risk IS NULL").count() == 5 and both.count() == 8


def test_payload_that_does_not_fit_gives_nulls(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "s": "a"}'), (2, "oops"), (3, None)], "id int, body string")
    rows = {r["id"]: (r["k"], r["s"]) for r in decode_payload(df, "body", "k INT, s STRING").collect()}
    assert rows == {1: (5, "a"), 2: (None, None), 3: (None, None)}


def test_ingest_keeps_the_layout_and_joins_small_folders(spark, folder):
    hot = Table(spark, folder + "/hot")
    archive.archive(hot, log(spark, 0, 0), 1000)
    stream = feed(spark, folder + "/src", [log(spark, 10 * k, 10 * k + 10) for k in range(6)])
    jobs.ingest(stream(), hot, folder + "/ck", compact_after=2)
    assert values(hot.read(), OFFSET) == list(range(60))
    leaves = hot.snapshot().leaves
    assert all(leaf.low is not None for leaf in leaves)
    assert len(leaves) <= 2 * len({tuple(leaf.values.items()) for leaf in leaves})


def test_small_batches_do_not_rewrite_the_archive(spark, folder):
    """Keys of all buckets change, yet the archive stays until the changes have come to a tenth of it."""
    table, pending = Table(spark, folder + "/a"), Table(spark, folder + "/p")
    cdc.create_archive(table, cold_rows(spark, range(20_000)), "OrderID", 8)
    events = [("u", k * 7 % 20_000, 20_000 + k, f"S{k}") for k in range(3_000)]
    log = change_log(spark, events)
    cdc.create_pending(pending, log, "OrderID")
    written, folds = set(), 0
    for n in range(6):
        part = log.where(f"kafka_offset >= {20_000 + 500 * n} AND kafka_offset < {20_500 + 500 * n}")
        pending.append(cdc.newest_events(part, "OrderID"), txn=("t", n))
        if cdc.fold_is_due(table, pending, 0.9):
            folds += cdc.fold_pending(table, pending, txn=("f", n)) > 0
        written |= {leaf.path for leaf in table.snapshot().leaves}
    assert folds <= 2 and len(written) <= 8 * (1 + folds)
    want = {k: "PENDING" for k in range(20_000)} | {e[1]: e[3] for e in events}
    assert statuses(cdc.state(table, pending)) == want


def test_state_starts_from_the_archive(spark, folder):
    """Deletes and changes of archived keys are known as such, stale events are dropped, and a restart goes on."""
    table, pending = Table(spark, folder + "/a"), Table(spark, folder + "/p")
    cdc.create_archive(table, cold_rows(spark, [7, 8, 9]).withColumn(OFFSET, F.col(OFFSET) + 50), "OrderID", 4)
    cdc.create_pending(pending, spark.createDataFrame([], SCHEMA), "OrderID")
    runs = [
        [("c", 1, 100, "NEW"), ("d", 7, 125), ("d", 20, 126), ("u", 8, 30, "STALE")],
        [("u", 1, 110, "SHIPPED"), ("c", 7, 140, "AGAIN"), ("d", 9, 58), ("d", 9, 127), ("u", 7, 139, "STALE")],
    ]
    want = [[("c", 1), ("d", 7)], [("u", 1), ("c", 7), ("d", 9)]]
    seen = 0
    for n, events in enumerate(runs):
        change_log(spark, events).coalesce(1).write.mode("append").parquet(folder + "/src")
        stream = spark.readStream.schema(SCHEMA).parquet(folder + "/src")
        seeded_stream(stream, "OrderID", table, pending, folder + "/ck", share=10)
        told = [(r["op"], (r["after"] or r["before"])["OrderID"]) for r in pending.read().collect()]
        assert sorted(told) == sorted(sum(want[: n + 1], [])) and len(told) > seen
        seen = len(told)
    assert statuses(cdc.state(table, pending)) == {1: "SHIPPED", 7: "AGAIN", 8: "PENDING"}


def test_seeded_state_needs_no_setting_of_the_session(spark, folder):
    """A session with Spark's default state store runs the job too, and keeps its setting."""
    setting, plain = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    own = spark.conf.get(setting)
    spark.conf.set(setting, plain)
    try:
        table, pending = _tables(spark, folder)
        stream = feed(spark, folder + "/src", [change_log(spark, EVENTS[i]) for i in (0, 1)])
        seeded_stream(stream(), "OrderID", table, pending, folder + "/ck", share=10)
        assert spark.conf.get(setting) == plain
    finally:
        spark.conf.set(setting, own)
    assert statuses(cdc.state(table, pending)) == {1: "SHIPPED", 3: "NEW", 8: "PENDING"}


def test_larger_logs_give_larger_batches(spark, folder):
    """A feed of many files comes in as many batches as one of few."""
    for n, tasks in enumerate((1, 8)):
        rows, hot = log(spark, 0, 4000).repartition(tasks), Table(spark, f"{folder}/{n}")
        hot.create(rows.where(F.lit(False)))
        jobs.ingest(_feed(spark, rows), hot, f"{folder}/ck{n}")
        assert hot.snapshot().applied["ingest"] == 3  # batches 0 to 3
        assert values(hot.read(), OFFSET) == list(range(4000))
