"""Sets of offsets as bitmaps."""

from lakelog.functions import bitmaps
from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import archive, replay
from lakelog.operators.coverage import Coverage
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Table

SCHEMA = f"{PARTITION} int, {OFFSET} long, v string"
EDGES = [-40_000, -32_768, -1, 0, 1, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12]


def log(spark, offsets, partition=0):
    return spark.createDataFrame([(partition, o, str(o)) for o in offsets], SCHEMA)


def offsets(df):
    return sorted(r[OFFSET] for r in df.collect())


def test_inside_and_outside(spark):
    known = bitmaps.build(log(spark, EDGES[::2] * 3))
    assert sum(r["rows"] for r in known.collect()) == 3 * len(EDGES[::2])
    rows = log(spark, EDGES).unionByName(log(spark, EDGES, 1))
    assert offsets(bitmaps.inside(rows, known)) == EDGES[::2]
    assert offsets(bitmaps.outside(rows, known)) == sorted(EDGES + EDGES[1::2])
    both = known.select(PARTITION, bitmaps.SLOT, bitmaps.BITMAP)
    both = both.unionByName(bitmaps.build(log(spark, EDGES, 1)).select(both.columns))
    assert offsets(bitmaps.outside(rows, both)) == EDGES[1::2]
    assert offsets(bitmaps.outside(rows, both.limit(0))) == sorted(EDGES * 2)


def test_rows_without_coordinates_are_outside(spark):
    rows = spark.createDataFrame([(0, None, "a"), (None, 5, "b"), (0, 5, "c")], SCHEMA)
    known = bitmaps.build(rows)
    assert {r["v"] for r in bitmaps.outside(rows, known).collect()} == {"a"} | ({"b"} if known.count() else set())
    assert bitmaps.build(rows.limit(0)).count() == 0


def test_commits_keep_their_offsets(spark, folder):
    """Sets follow the folders that are live, through append, compaction and vacuum."""
    table = Table(spark, folder)
    archive.archive(table, log(spark, range(0, 300, 2)), width=100)
    archive.append(table, log(spark, range(100, 200)))
    assert [(x.low, x.high, x.rows, x.offsets) for x in table.snapshot().leaves] == [
        (0, 98, 50, 50), (100, 198, 50, 50), (200, 298, 50, 50), (101, 199, 50, 50)]
    for _ in range(2):
        known = table.offset_sets(table.snapshot())
        rows = log(spark, range(310))
        assert offsets(bitmaps.inside(rows, known)) == offsets(table.read())
        part = table.offset_sets(table.snapshot(), lambda leaf: leaf.low < 100)
        assert offsets(bitmaps.inside(rows, part)) == list(range(0, 100, 2))
        table.compact()
    table.vacuum(1)
    assert offsets(bitmaps.inside(rows, table.offset_sets(table.snapshot()))) == offsets(table.read())


def test_append_does_not_shuffle_offsets(spark, folder):
    """What the archive may hold is joined slot by slot, and bitmaps are built before any shuffle."""
    table = Table(spark, folder)
    archive.archive(table, log(spark, range(0, 300, 2)), width=100)
    fresh = Coverage.of(table).unarchived(log(spark, range(300)))
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_or_agg" in plan and f"{OFFSET}#" in plan and "LeftAnti" not in plan
    assert offsets(fresh) == list(range(1, 300, 2))


def test_gaps_are_those_of_the_sorted_offsets(spark):
    size = bitmaps.SIZE
    odd = {0: {0, 1, 5, size - 1, size, size + 1, 2 * size, 2 * size + 1, 5 * size + 7},
           1: set(range(-size - 3, 2 * size + 1)) - {-size, -1, 0, 7, 8, 9, size},
           2: set(range(1, 3 * size + 1)) - set(range(40, size + 20)), 3: {12}, 4: set(range(10_000, 40_000, 2)),
           None: {3, 5}}
    rows = spark.createDataFrame([(p, o) for p, own in odd.items() for o in own] + [(3, 12), (0, None), (5, None)],
                                 f"{PARTITION} int, {OFFSET} bigint")
    want = sorted((str(p), a + 1, b - 1, b - a - 1) for p, own in odd.items()
                  for a, b in zip(sorted(own), sorted(own)[1:], strict=False) if b > a + 1)
    found = replay.gaps(rows)
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == want
    assert replay.gaps(rows.where("FALSE")).count() == 0


def test_gaps_take_one_scan_and_stored_tiers_read_no_records(spark, folder):
    rows = log(spark, [*range(300), *range(400, 900)])
    cold = Table(spark, folder)
    archive.archive(cold, rows.where(f"{OFFSET} < 600"), 100)
    archive.append(cold, rows)
    plain = replay.gaps(cold.read())
    got = list(map(tuple, plain.collect()))
    assert got == [(0, 300, 399, 100)]
    plan = plain._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and f"ReadSchema: struct<{OFFSET}:bigint>" in plan
    stored = replay.gaps_topic(Topic("t", cold=cold))
    assert list(map(tuple, stored.collect())) == got
    assert OFFSET not in stored._jdf.queryExecution().executedPlan().toString()
