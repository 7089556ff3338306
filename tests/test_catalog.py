import pytest
from pyspark.sql import functions as F

from lakelog.operators import archive, cdc
from lakelog.operators.index import OffsetIndex
from lakelog.operators.tiers import Topic
from lakelog.plans.catalog import TierCatalog
from lakelog.sources.store import Table
from tests.test_cdc import STORY, change_log, cold_rows, statuses
from tests.test_store import log


@pytest.fixture
def catalog(spark, folder):
    def stored(name, df, width=100):
        t = Table(spark, f"{folder}/{name}")
        archive.archive(t, df, width)
        return t

    changes = Table(spark, folder + "/changes")
    changes.create(change_log(spark, STORY))
    orders = Table(spark, folder + "/orders")
    cdc.create_archive(orders, cold_rows(spark, [1, 2, 5]), "OrderID", 4)
    hot = stored("hot", log(spark, 200, 400).withColumn("risk", F.lit(1.0)))
    return TierCatalog(spark, [
        Topic("trades", hot=hot, cold=stored("cold", log(spark, 0, 250))),
        Topic("clicks", hot=stored("clicks", log(spark, 0, 7))),
        Topic("taxes", cold=stored("taxes", log(spark, 0, 9))),
        Topic("orders", key="OrderID", hot=changes, cold=orders),
    ], extra=["today"]).publish()


def test_listings(catalog):
    assert catalog.namespaces() == ["cold", "deletes", "hot", "merged", "today"]
    assert catalog.tables("hot") == ["clicks", "orders", "trades"]
    assert catalog.tables("cold") == ["orders", "taxes", "trades"]
    assert catalog.tables("merged") == ["clicks", "orders", "taxes", "trades"]
    assert catalog.tables("today") == []
    assert set(catalog.tables("merged")) == set(catalog.tables("hot")) | set(catalog.tables("cold"))


def test_counts_per_tier(catalog):
    counts = {(r["namespace"], r["table_name"]): r["row_count"] for r in catalog.inventory().collect()}
    assert counts[("hot", "trades")] == 200 and counts[("cold", "trades")] == 250
    assert counts[("merged", "trades")] == 400
    assert counts[("merged", "clicks")] == 7 and counts[("merged", "taxes")] == 9


def test_describe_hides_the_envelope(catalog):
    names = [n for n, _ in catalog.describe("hot", "orders")]
    assert names == ["OrderID", "CustomerID", "Status", "Amount",
                     "kafka_partition", "kafka_offset", "kafka_timestamp"]


def test_sql_resolves_to_the_tier(spark, catalog):
    text = "SELECT COUNT(*) AS n FROM trades"
    assert [catalog.query(text, t).first()["n"] for t in ("hot", "cold", "merged")] == [200, 250, 400]
    qualified = catalog.query("SELECT (SELECT COUNT(*) FROM hot.trades) AS h, "
                              "(SELECT COUNT(*) FROM cold.trades) AS c")
    assert tuple(qualified.first()) == (200, 250)
    assert spark.catalog.currentDatabase() == "default"
    assert catalog.query("SELECT * FROM trades WHERE risk IS NULL").count() == 250


def test_keyed_topic_views_equal_the_dataframe_views(catalog):
    topic = catalog.topics["orders"]
    plain = Topic("orders", key="OrderID", hot=topic.hot, cold=lambda: cdc.read_archive(topic.cold))
    for tier in ("hot", "cold", "merged"):
        assert statuses(catalog.query("SELECT * FROM orders", tier)) == statuses(plain.tier(tier))
    gone = catalog.query("SELECT * FROM orders", "deletes")
    assert {r["OrderID"] for r in gone.collect()} == {2, 9}


def test_queries_see_the_newest_version(spark, catalog):
    trades = catalog.topics["trades"]
    trades.hot.append(log(spark, 400, 450).withColumn("risk", F.lit(2.0)).withColumn(
        "offset_bucket", F.lit(400).cast("bigint")))
    assert catalog.query("SELECT COUNT(*) AS n FROM trades").first()["n"] == 450
    archive.evolve(trades.cold, trades.hot.read(), {"risk": "v"})
    archive.append(trades.cold, trades.hot.read())
    assert catalog.query("SELECT COUNT(*) AS n FROM trades").first()["n"] == 450
    assert catalog.query("SELECT COUNT(*) AS n FROM trades", "cold").first()["n"] == 450


def test_index_narrows_a_sql_query(spark, folder, catalog):
    cold = catalog.topics["taxes"].cold
    catalog.add_index("taxes", OffsetIndex.build(spark, folder + "/i", cold.read(), "v", "ABS($field)", 2))
    text = "SELECT kafka_offset FROM taxes WHERE ABS(v) = 30"
    used = catalog.query(text, index=("taxes", "ABS(v)", 30))
    assert [r[0] for r in used.collect()] == [r[0] for r in catalog.query(text).collect()] == [3]
    other = catalog.query("SELECT kafka_offset FROM taxes WHERE v = 30", index=("taxes", "v", 30))
    assert [r[0] for r in other.collect()] == [3]


@pytest.fixture
def indexed(spark, folder):
    """A topic with two indexes, and rows that are live only."""
    rows = log(spark, 0, 400).withColumn("Name", F.concat(F.lit(" n"), (F.col("kafka_offset") % 50).cast("string")))
    cold, hot = Table(spark, folder + "/c"), Table(spark, folder + "/h")
    archive.archive(cold, rows.where("kafka_offset < 300"), 100)
    archive.archive(hot, rows.where("kafka_offset >= 250"), 100)
    catalog = TierCatalog(spark, [Topic("names", hot=hot, cold=cold, width=100)]).publish()
    for template in ("UPPER(TRIM($field))", "SUBSTRING($field, 1, 3)"):
        catalog.add_index("names", OffsetIndex.build(spark, f"{folder}/{len(template)}", cold, "Name", template, 2))
    return catalog


# The text, and how many values an index is asked for; none if it does not serve the query.
TEXTS = [
    ("SELECT * FROM names WHERE UPPER(TRIM(Name)) = 'N7'", 1),
    ("SELECT * FROM names WHERE 'N7' = upper(trim(name)) AND kafka_offset > 60", 1),
    ("SELECT * FROM names WHERE Name = ' n7'", 1),
    ("SELECT * FROM names WHERE UPPER(TRIM(Name)) IN ('N7', 'N8', NULL)", 2),
    ("SELECT * FROM names WHERE UPPER(TRIM(Name)) = 'N7' OR (UPPER(TRIM(Name)) = 'N8' AND v > 0)", 2),
    ("SELECT * FROM names WHERE UPPER(TRIM(Name)) = 'N7' OR v > 3900", None),
    ("SELECT * FROM names WHERE NOT UPPER(TRIM(Name)) = 'N7'", None),
    ("SELECT * FROM names WHERE UPPER(Name) = ' N7'", None),
    ("SELECT * FROM names WHERE UPPER(TRIM(Name)) = NULL", None),
    ("SELECT * FROM (SELECT UPPER(TRIM(Name)) AS k, v FROM names) WHERE k = 'N9'", 1),
    ("WITH x AS (SELECT Name, v FROM names) SELECT v FROM x WHERE Name = ' n9' UNION ALL SELECT v FROM x WHERE Name = ' n3'", 2),
    ("SELECT a.v FROM names a JOIN names b ON a.Name = b.Name WHERE a.Name = ' n9'", 1),
    ("SELECT COUNT(*) FROM names a JOIN names b ON a.v = b.v WHERE a.Name = ' n9'", None),
    ("SELECT COUNT(*) FROM names WHERE Name = ' n9' AND v > (SELECT AVG(v) FROM names)", None),
    ("SELECT COUNT(*) FROM names WHERE Name = ' n9' AND v > (SELECT MIN(v) FROM names WHERE Name = ' n8')", 2),
    ("SELECT a.v FROM names a LEFT JOIN (SELECT * FROM names WHERE Name = ' n9') b ON a.v = b.v", None),
    ("SELECT Name, COUNT(*) FROM names GROUP BY Name HAVING Name = ' n9'", 1),
    ("SELECT COUNT(*) FROM merged.names WHERE Name = ' n9'", None),
]


def test_the_plan_tells_what_an_index_is_asked(spark, indexed, monkeypatch):
    asked: list[str] = []
    candidates = Topic.candidates
    monkeypatch.setattr(Topic, "candidates", lambda self, index, probe, live: (
        asked.append(probe), candidates(self, index, probe, live))[1])
    for text, values in TEXTS:
        asked.clear()
        got = sorted(map(tuple, indexed.query(text, index=True).collect()))
        assert [p.count("SUBSTRING") or p.count(",") + 1 for p in asked] == ([] if values is None else [values]), text
        assert got == sorted(map(tuple, indexed.query(text).collect())), text
        assert not spark.catalog.tableExists("names")


def test_long_lists_and_odd_constants(spark, indexed):
    names = ", ".join(f"'N{i}'" for i in range(0, 50, 2))
    for text in (f"SELECT v FROM names WHERE UPPER(TRIM(Name)) IN ({names})",
                 "SELECT v FROM names WHERE UPPER(TRIM(Name)) = 'it\\'s \\\\ odd'"):
        assert sorted(indexed.query(text, index=True).collect()) == sorted(indexed.query(text).collect())
    assert spark.conf.get("spark.sql.optimizer.inSetConversionThreshold") == "10"


def test_only_matching_blocks_are_read_and_commands_run_once(spark, indexed):
    text = "SELECT v FROM names WHERE Name = ' n7'"
    plan = indexed.query(text, "cold", index=True)._jdf.queryExecution().executedPlan().toString()
    assert "kafka_offset" in plan and "kafka_offset" not in (
        indexed.query(text, "cold")._jdf.queryExecution().executedPlan().toString())
    assert indexed.query(text, "hot", index=True).count() == indexed.query(text, "hot").count() == 3
    indexed.query("CREATE DATABASE names_once -- names", index=True)  # a second run would fail
    spark.sql("DROP DATABASE names_once")


def test_a_temporary_view_hides_the_table(spark, indexed):
    spark.range(3).selectExpr("' n7' AS Name").createOrReplaceTempView("names")
    try:
        assert indexed.query("SELECT * FROM names WHERE Name = ' n7'", index=True).count() == 3
        assert spark.table("names").count() == 3
    finally:
        spark.catalog.dropTempView("names")


def test_stale_topics_are_dropped(catalog):
    del catalog.topics["clicks"]
    catalog.publish()
    assert "clicks" not in catalog.tables("merged")


def test_a_second_catalog_leaves_the_first_alone(spark, folder, catalog):
    only = Table(spark, folder + "/only")
    only.create(log(spark, 0, 3))
    other = TierCatalog(spark, [Topic("other", hot=only)]).publish()
    assert other.tables("hot") == ["other"]
    other.topics.clear()
    other.publish()
    assert other.tables("hot") == [] and catalog.tables("hot") == ["clicks", "orders", "trades"]
    assert spark.table("hot.trades").count() == 200
