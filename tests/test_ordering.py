import math
import random

import pytest
from pyspark.sql import functions as F

from lakelog.operators import ordering
from lakelog.operators.ordering import dense_number, pick_ranks, write_ordered


def test_dense_number_with_one_dominant_key(spark):
    rng = random.Random(3)
    data = [(0 if rng.random() < 0.5 else rng.randrange(100), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, id bigint").repartition(5)
    out = dense_number(df, [F.col("k").desc(), F.col("id")], "n")
    got = [(r["n"], r["k"], r["id"]) for r in out.collect()]
    want = sorted(data, key=lambda d: (-d[0], d[1]))
    assert sorted(got) == [(n, k, i) for n, (k, i) in enumerate(want)]


def test_width_of_range_chunks(spark, folder, monkeypatch):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unknown = spark.createDataFrame([(1,)], "id int")
    assert ordering.range_tasks(unknown) == width
    spark.range(100_000).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert ordering.range_tasks(stored.join(stored.withColumnRenamed("id", "j"))) == width
    monkeypatch.setattr(ordering, "CHUNK_BYTES", 10_000)
    assert ordering.range_tasks(stored) > width


def test_many_chunks_use_a_small_join(spark, monkeypatch):
    monkeypatch.setattr(ordering, "LITERAL_BASES", 1)
    out = dense_number(spark.range(100).toDF("id"), [F.col("id").desc()], "n", start=5)
    assert sorted((r["n"], r["id"]) for r in out.collect()) == [(5 + i, 99 - i) for i in range(100)]


def test_no_rows(spark):
    df = spark.range(10).where("id < 0")
    assert dense_number(df, [F.col("id")], "n").count() == 0


def test_slices_cover_the_whole(spark):
    ordered = write_ordered(spark.range(1000).toDF("id"), [F.col("id")], "t")
    df = ordered.read(spark)
    for low, high in ((0, 10), (90, 400), (0, 1000), (995, 2000), (2000, 2010)):
        got = ordered.slice(df, "n", low, high)
        assert sorted(r["n"] for r in got.collect()) == list(range(low, min(high, 1000)))
        assert got.where("n <> id").count() == 0


def test_slice_reads_matching_chunks_only(spark):
    ordered = write_ordered(spark.range(1000).toDF("id"), [F.col("id")], "t")
    part = ordered.slice(ordered.read(spark), "n", 10, 20)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__chunk" in plan
    assert "GreaterThanOrEqual(__row" in plan


def test_ranks_against_brute_force(spark):
    rng = random.Random(11)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(4)}", rng.choice([1.5, rng.random()]))
            for _ in range(1500)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    n = F.col("n")
    out = pick_ranks(df, "g", "v", {
        "p50": F.floor(n / 2), "p95": F.least(n - 1, F.floor((n * 95 + 99) / 100) - 1)})
    groups: dict = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    want = {}
    for g, vs in groups.items():
        vs.sort()
        want[g] = (len(vs), vs[len(vs) // 2],
                   vs[min(len(vs) - 1, math.ceil(len(vs) * 0.95) - 1)])
    assert {r["g"]: (r["n"], r["p50"], r["p95"]) for r in out.collect()} == want


@pytest.mark.parametrize("size", [1, 2, 20, 21])
def test_upper_median_rule(spark, size):
    df = spark.range(size).select(F.lit("a").alias("g"), F.col("id").alias("v"))
    assert pick_ranks(df, "g", "v", {"p": F.floor(F.col("n") / 2)}).first()["p"] == size // 2
