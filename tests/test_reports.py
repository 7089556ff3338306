import random
import statistics

from pyspark.sql import functions as F

from lakelog.functions import scalars
from lakelog.plans import reports


def test_population_equals_pairs(spark):
    rng = random.Random(5)
    stops = [(rng.choice("ab"), rng.choice(["delivered", "undelivered"])) for _ in range(30)]
    stops += [("solo", "delivered")]
    places = [(rng.choice("abx"), rng.random(), rng.random()) for _ in range(60)] + [("solo", 1.0, 2.0)]
    out = reports.route_population(
        spark.createDataFrame(stops, "routeId string, state string"),
        spark.createDataFrame(places, "routeId string, x double, y double"), "delivered")
    for row in out.collect():
        pairs = [(s, p) for s in stops for p in places if s[0] == p[0] == row["routeId"]]
        assert row["pair_count"] == len(pairs)
        share = sum(s[1] == "delivered" for s, _ in pairs) / len(pairs)
        assert abs(row["delivered_share"] - share) < 0.0006
        if len(pairs) == 1:
            assert row["spread"] is None
        else:
            dev = sum(statistics.stdev(p[i] for _, p in pairs) for i in (1, 2))
            assert abs(row["spread"] - dev) < 1e-5
    assert {r["routeId"] for r in out.collect()} == {"a", "b", "solo"}


def test_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "state string")
    assert reports.hit_rate(empty, "hit").first()[0] is None


def test_bad_scores_are_left_out(spark):
    rows = [(1, "s", '{"name": "A", "score": "7"}'), (1, "s", '{"name": "A", "score": "9"}'),
            (2, "s", '{"name": "B", "score": "bad"}'), (3, "s", ""), (4, "other", '{"score": 1}'),
            (5, "s", '{"name": "C", "score": 9}')]
    df = spark.createDataFrame(rows, "routeId int, event_type string, data string")
    out = reports.leaderboard(df, "s", F.get_json_object("data", "$.name"), "$.score")
    assert [tuple(r) for r in out.collect()] == [("A", 9), ("C", 9)]


def test_union_drops_equal_lines(spark):
    df = spark.range(3)
    assert reports.tier_counts({"a": df, "b": df}).count() == 2
    same = {"a": df}
    assert reports.tier_counts(same, distinct=True).collect()[0]["row_count"] == 3


def test_seconds_are_truncated(spark):
    df = spark.createDataFrame([(1700000000999,)], "ms bigint")
    row = df.select(scalars.epoch_seconds(F.col("ms")), scalars.epoch_text(F.col("ms")),
                    scalars.hour_text(F.col("ms"))).first()
    assert tuple(row) == (1700000000, "2023-11-14 22:13:20", "2023-11-14 22:00")


def test_ratio_without_base(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(scalars.ratio(F.col("a"), F.col("b"))).collect()] == [2.0, 0.0]


def test_literals_are_quoted(spark):
    for value in ("it's", "back\\slash", 5, 1.5, True, None):
        got = spark.range(1).select(F.expr(scalars.sql_literal(value)).alias("v")).first()["v"]
        assert got == value or (value == 1.5 and float(got) == value)
