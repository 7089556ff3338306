"""Hard negatives against plain Python."""

import math

import numpy as np
from pyspark.sql import functions as F

from lakelog.llm.hard_negatives import mine, scores, subset_sums, _aligned, _planes
import pyarrow as pa

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, step, positives=5, negatives=3):
    """Sorted result rows for [(id, vector, label)]."""
    part = []
    for own, vec, label in rows:
        if own is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if all(abs(math.floor(256 * x)) * math.sqrt(len(vec)) < 2**28 for x in vec):
            part.append((own, [math.floor(256 * x) for x in vec], label))
    out = []
    for i, (own, vec, label) in enumerate(part):
        if own % step:
            continue
        score = [sum(x * y for x, y in zip(vec, v, strict=False)) for _, v, _ in part]
        order = sorted((k for k in range(len(part)) if k != i), key=lambda k: (-score[k], part[k][0]))
        for p in [k for k in order if part[k][2] == label][:positives]:
            fits = [k for k in order if part[k][2] != label and 50 * score[p] <= 100 * score[k] <= 95 * score[p]]
            for rank, k in enumerate(fits[:negatives], 1):
                out.append((own, part[p][0], rank, part[k][0], score[p], score[k]))
    return sorted(out)


def found(spark, rows, step, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(x) for x in mine(df, F.col("vec_id") % step == 0, **options).collect())


def test_scores_are_exact():
    random = np.random.default_rng(3)
    for size, top in ((1, 5), (8, 300), (13, 2**20), (64, 2**24)):
        a, x = random.integers(-top, top, (5, size)), random.integers(-top, top, (40, size))
        bits, planes = zip(*(_planes(v) for v in x), strict=True)
        rows = pa.table({"bits": pa.array(bits, pa.int32()), "planes": pa.array([p.tobytes() for p in planes], pa.binary())})
        assert (scores(subset_sums(a), _aligned(rows, -(-size // 8))) == x @ a.T).all()


def test_against_plain_python(spark):
    random = np.random.default_rng(11)
    centres = random.normal(size=(4, 20))
    rows = [(k, [float(x) for x in centres[k % 4] + random.normal(size=20) * 0.7], int(random.integers(0, 3))) for k in range(300)]
    rows += [(1000 + k, [0.5] * 20, k % 2) for k in range(60)]  # ties and a common vector
    want = brute(rows, 10)
    assert len(want) > 200
    assert found(spark, rows, 10) == want
    assert found(spark, rows, 10, positives=2, negatives=1) == brute(rows, 10, 2, 1)


def test_many_blocks_give_the_same(spark, monkeypatch):
    from lakelog.llm import hard_negatives

    random = np.random.default_rng(12)
    rows = [(k, [float(x) for x in random.integers(-2, 3, 9)], k % 5 // 3) for k in range(200)]
    for name, value in (("ROWS", 30), ("ANCHORS", 8), ("TABLES", 3), ("SLICE", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert found(spark, rows, 4) == brute(rows, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 2),  # one id three times
        (2, [1.0], 1), (4, [], 1), (6, [1.0, 2.0, 3.0], 2), (8, [0.5, 1.0], 2), (10, [0.6, 1.2], 2), (12, [0.0, 0.0], 2),
        (None, [1.0, 2.0], 1), (14, None, 1), (16, [1.0, None], 1), (18, [nan, 1.0], 2), (20, [inf, 1.0], 2),
        (22, [1.0, 2.0], None), (24, [1e300, 1.0], 2), (26, [-5e5, 1.0], 2), (28, [7e5, 7e5], 1), (-50, [-1.0, -2.0], 1),
        (-4, [-0.7, -1.3], 2),
    ]
    want = brute(rows, 2)
    assert want
    assert found(spark, rows, 2) == want


def test_empty_and_clashing_columns(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [(1, [1.0], 1), (3, [1.0], 2)], 2) == []  # no anchor
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    more = [F.lit(0).alias(c) for c in ("id", "row", "score", "anchor", "rank", "positive_id", "bucket", "numbers")]
    got = mine(df.select("*", *more), F.col("vec_id") == 0).collect()
    assert [tuple(x) for x in got] == brute(rows, 100)
