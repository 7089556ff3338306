import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.functions.coords import BUCKET, OFFSET, PARTITION, offset_range
from lakelog.operators import archive
from lakelog.sources.files import CommitConflict, Pointer
from lakelog.sources.store import Table


def log(spark, low, high):
    return spark.range(low, high).select(
        (F.col("id") % 2).cast("int").alias(PARTITION), F.col("id").alias(OFFSET),
        F.lit(None).cast("timestamp_ntz").alias("kafka_timestamp"),
        (F.col("id") * 10).alias("v"))


def values(df, column="v"):
    return sorted(r[column] for r in df.collect())


def test_archive_layout_and_frontier(spark, folder):
    t = Table(spark, folder)
    snap = archive.archive(t, log(spark, 0, 1000), 100)
    assert len(snap.leaves) == 20
    assert snap.frontier() == {0: 998, 1: 999}
    assert {leaf.rows for leaf in snap.leaves} == {50}
    assert t.read().count() == 1000


def test_offset_predicate_prunes_folders(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 1000), 100)
    df = t.read().where(offset_range(250, 260, 1, width=100))
    plan = df._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "kafka_partition" in line and "offset_bucket" in line
    assert "GreaterThanOrEqual(kafka_offset,250)" in line
    assert len(df.inputFiles()) >= 1 and values(df) == [2510, 2530, 2550, 2570, 2590]


def test_append_is_idempotent(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 300), 100)
    for _ in range(2):
        archive.append(t, log(spark, 200, 500))
    assert values(t.read(), OFFSET) == list(range(500))


def test_append_late_rows_below_the_boundary(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 400, 500), 100)
    for _ in range(2):
        archive.append(t, log(spark, 100, 450))
        assert values(t.read(), OFFSET) == list(range(100, 500))


def test_append_by_position(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 10), 100)
    other = log(spark, 10, 12).select("v", PARTITION, OFFSET, "kafka_timestamp")
    names = [c for c in t.snapshot().schema.names if c != BUCKET]
    moved = other.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(names)])
    archive.append(t, moved, by_position=True)
    assert values(t.read())[-2:] == [100, 110]


def test_transaction_is_applied_once(spark, folder):
    t = Table(spark, folder)
    t.create(log(spark, 0, 5))
    for _ in range(3):
        t.append(log(spark, 5, 8), txn=("job", 0))
    t.append(log(spark, 8, 9), txn=("job", 1))
    assert t.read().count() == 9


def test_readers_keep_their_version(spark, folder):
    t = Table(spark, folder)
    t.create(log(spark, 0, 5))
    old = t.snapshot()
    t.append(log(spark, 5, 9))
    assert t.read(old).count() == 5
    assert t.read().count() == 9
    assert Table(spark, folder).read().count() == 9


def test_second_writer_of_a_version_fails(spark, folder):
    p = Pointer(spark, folder)
    p.swap(0, {"a": 1})
    with pytest.raises(CommitConflict):
        p.swap(0, {"a": 2})
    assert p.load() == (1, {"a": 1})


def test_replace_keeps_untouched_folders(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 400), 100)
    before = {leaf.path for leaf in t.snapshot().leaves}
    part = t.read(keep=lambda leaf: leaf.values[BUCKET] == 100).withColumn("v", F.lit(-1))
    t.replace(part.select(*t.snapshot().schema.names), lambda leaf: leaf.values[BUCKET] == 100)
    after = {leaf.path for leaf in t.snapshot().leaves}
    assert len(before & after) == 6 and len(after) == 8
    assert t.read().where("v = -1").count() == 100 and t.read().count() == 400


def test_compact_and_vacuum(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 50), 100)
    for low in (50, 60, 70):
        archive.append(t, log(spark, low, low + 10))
    assert len(t.snapshot().leaves) == 8
    t.compact()
    assert len(t.snapshot().leaves) == 2
    assert values(t.read(), OFFSET) == list(range(80))
    assert len(t.vacuum(keep=1)) == 4
    assert t.read().count() == 80


def test_add_column_at_position_then_archive(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 10), 100)
    hot = log(spark, 5, 15).withColumn("risk", F.lit(0.5))
    assert archive.evolve(t, hot, {"risk": "v"}) == ["risk"]
    names = t.snapshot().schema.names
    assert names.index("risk") == names.index("v") + 1
    archive.append(t, hot)
    assert t.read().where("risk IS NULL").count() == 10
    assert t.read().where("risk = 0.5").count() == 5


def test_unknown_column_is_refused(spark, folder):
    t = Table(spark, folder)
    t.create(log(spark, 0, 3))
    with pytest.raises(ValueError):
        t.append(log(spark, 3, 4).withColumn("new", F.lit(1)))


def test_view_sql_reads_the_same_rows(spark, folder):
    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 300), 100)
    t.add_column("risk", T.DoubleType(), "v")
    archive.append(t, log(spark, 300, 350).withColumn("risk", F.lit(1.0)))
    t.replace(None, lambda leaf: leaf.values == {PARTITION: 0, BUCKET: 0})
    view = spark.sql(t.view_sql())
    assert view.schema.names == t.read().schema.names
    assert view.exceptAll(t.read()).count() == 0 and view.count() == t.read().count() == 300


def test_trim_drops_and_splits_folders(spark, folder):
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    archive.archive(cold, log(spark, 0, 250), 100)
    archive.archive(hot, log(spark, 100, 400), 100)
    keep = {leaf.path for leaf in hot.snapshot().leaves if leaf.low >= 300}
    assert archive.trim_hot(hot, cold) == 150
    assert values(hot.read(), OFFSET) == list(range(250, 400))
    assert keep <= {leaf.path for leaf in hot.snapshot().leaves}
    archive.append(cold, hot.read())
    assert archive.trim_hot(hot, cold) == 0 and hot.read().count() == 0


def test_ordered_archive_is_globally_sorted(spark, folder):
    t = Table(spark, folder)
    rows = log(spark, 0, 500).withColumn(
        "kafka_timestamp",
        F.timestamp_seconds(F.col(OFFSET) * 7919 % 50).cast("timestamp_ntz"))
    archive.archive_ordered(t, rows)
    files = t.read().select("kafka_timestamp", "_metadata.file_path").groupBy("file_path").agg(
        F.min("kafka_timestamp").alias("lo"), F.max("kafka_timestamp").alias("hi"))
    spans = sorted((r["lo"], r["hi"]) for r in files.collect())
    assert len(spans) > 1
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_bloom_filter_option_reaches_the_files(spark, folder):
    t = Table(spark, folder)
    snap = archive.archive(t, log(spark, 0, 100), 100, bloom=["v"])
    assert snap.props["options"] == {"parquet.bloom.filter.enabled#v": "true"}
    assert t.read().where("v = 420").count() == 1


def test_bloom_filters_skip_row_groups(spark, folder):
    """A value between the smallest and the largest that no row has: statistics do not rule it out."""

    def rows_read(name, bloom):
        t = Table(spark, f"{folder}/{name}")
        data = log(spark, 0, 2000).withColumn("s", F.concat(F.lit("k"), (F.col("v") * 7919 % 100003).cast("string")))
        data = data.withColumn(PARTITION, F.lit(0)).repartition(1)
        archive.archive(t, data, 10_000, bloom=bloom)
        found = t.read().where("s = 'k5x'")
        assert found.collect() == []
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        plan = leaves.head().executedPlan().collectLeaves().head() if "AQE" in leaves.head().nodeName() or (
            "ShuffleQueryStage" in leaves.head().nodeName()) else leaves.head()
        return plan.metrics().apply("numOutputRows").value()

    assert rows_read("plain", []) == 2000
    assert rows_read("bloom", ["s"]) == 0


def test_trim_keeps_what_is_not_archived(spark, folder):
    """An archive that begins in the middle of the live log; then one that is filled out of order."""
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    archive.archive(hot, log(spark, 0, 600), 100)
    archive.archive(cold, log(spark, 400, 500), 100)
    assert archive.trim_hot(hot, cold) == 500
    assert values(hot.read().unionByName(cold.read()), OFFSET) == list(range(600))
    archive.append(cold, log(spark, 0, 600).where(f"{OFFSET} % 7 = 0"))
    left = archive.trim_hot(hot, cold)
    assert left == len([o for o in range(600) if o % 7 and not 400 <= o < 500])
    assert values(hot.read().unionByName(cold.read()), OFFSET) == list(range(600))
    assert archive.trim_hot(hot, cold) == left


def test_ordered_archives_and_plain_logs_can_trim(spark, folder):
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    hot.create(log(spark, 0, 300))
    archive.archive_ordered(cold, log(spark, 100, 200))
    assert archive.trim_hot(hot, cold) == 200
    assert values(hot.read().unionByName(cold.read()), OFFSET) == list(range(300))


def test_commits_start_from_the_snapshot_that_was_read(spark, folder, monkeypatch):
    """A writer in between makes the job fail; nothing is lost or doubled."""
    from lakelog.operators.coverage import Coverage

    t = Table(spark, folder)
    archive.archive(t, log(spark, 0, 80), 100)
    archive.append(t, log(spark, 80, 150))
    read, of = Table.read, Coverage.of

    def slow_read(self, *args):
        monkeypatch.setattr(Table, "read", read)
        archive.append(Table(spark, folder), log(spark, 150, 160))
        return read(self, *args)

    monkeypatch.setattr(Table, "read", slow_read)
    with pytest.raises(CommitConflict):
        t.compact()
    assert values(t.read(), OFFSET) == list(range(160))

    def slow_coverage(table, snap=None):
        monkeypatch.setattr(Coverage, "of", staticmethod(of))
        found = of(table, snap)
        archive.append(Table(spark, folder), log(spark, 160, 200))
        return found

    monkeypatch.setattr(Coverage, "of", staticmethod(slow_coverage))
    with pytest.raises(CommitConflict):
        archive.append(t, log(spark, 160, 200))
    assert values(t.read(), OFFSET) == list(range(200))
