import pytest
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION
from lakelog.operators import archive, index
from lakelog.operators.frontier import Frontier
from lakelog.operators.index import OffsetIndex, effective_predicate, lookup
from lakelog.operators.tiers import Topic
from lakelog.sources.store import Table

UPPER_TRIM = "UPPER(TRIM($field))"
PREFIX = "SUBSTRING($field, 1, 27)"
# Two marker rows whose names differ in the last, 28th, character.
MARKERS = {333000: "Marker Name Of Some Length A", 663000: "Marker Name Of Some Length B"}


@pytest.fixture(scope="module")
def million(spark):
    """1,000,000 customers in one partition with markers at offsets 333000 and 663000."""
    name = F.concat(F.lit("Customer "), F.md5(F.col("id").cast("string")))
    for at, marker in MARKERS.items():
        name = F.when(F.col("id") == at, marker).otherwise(name)
    return spark.range(1_000_000).select(
        F.lit(0).alias(PARTITION), F.col("id").alias(OFFSET), name.alias("Name"))


def people(spark, n=400, partitions=3):
    return spark.range(n).select(
        (F.col("id") % partitions).cast("int").alias(PARTITION), F.col("id").alias(OFFSET),
        F.when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("  Name "), (F.col("id") % 40).cast("string"))).alias("Name"))


def offsets(df):
    return sorted(r[OFFSET] for r in df.collect())


def test_blocks_of_the_marker_rows(spark, million, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("idx"))
    upper = OffsetIndex.build(spark, base + "/u", million, "Name", "UPPER($field)")
    text = effective_predicate(upper, "Name", MARKERS[333000].upper(), "UPPER($field)")
    assert text["effective"] == (
        "((kafka_partition = 0 AND kafka_offset >= 333000 AND kafka_offset < 334000) OR "
        "(kafka_partition = 0 AND kafka_offset >= 999999)) AND "
        "UPPER(Name) = 'MARKER NAME OF SOME LENGTH A'")
    plain = effective_predicate(upper, "Name", MARKERS[333000])
    assert "kafka_offset >= 333000 AND kafka_offset < 334000" in plain["effective"]
    prefix = OffsetIndex.build(spark, base + "/p", million, "Name", PREFIX)
    blocks = {(r["low"], r["high"]) for r in
              prefix.explain(prefix.probe(PREFIX, MARKERS[333000][:27])).collect()}
    assert blocks == {(333000, 334000), (663000, 664000), (999999, None)}
    both = lookup(million, "Name", MARKERS[333000][:27], PREFIX, [prefix])
    assert offsets(both) == [333000, 663000]
    one = lookup(million, "Name", MARKERS[663000], "$field", [prefix])
    assert offsets(one) == [663000]


@pytest.mark.parametrize("literal,broadcast", [(512, 1000), (0, 1000), (0, 1)])
@pytest.mark.parametrize("template", ["$field", UPPER_TRIM, "SUBSTRING($field, 1, 8)"])
def test_parity_of_all_ways(spark, folder, monkeypatch, literal, broadcast, template):
    """Ranges, semi join and full scan return what the predicate alone returns."""
    monkeypatch.setattr(index, "LITERAL_GRANULES", literal)
    monkeypatch.setattr(index, "BROADCAST_GRANULES", broadcast)
    log = people(spark)
    idx = OffsetIndex.build(spark, folder, log, "Name", template, 10,
                            Frontier({0: 200, 1: 250}))
    for value in ("  Name 7", "  Name 39", "  Name 1", "nobody", "it's"):
        want = offsets(log.where(F.col("Name") == value))
        assert offsets(lookup(log, "Name", value, "$field", [idx])) == want
    probe = F.expr(template.replace("$field", "'  Name 7'"))
    value = spark.range(1).select(probe.alias("p")).first()["p"]
    want = offsets(log.where(F.expr(template.replace("$field", "Name")) == value))
    got = lookup(log, "Name", value, template, [idx])
    assert offsets(got) == want and len(want) > 0


def test_unserved_predicates_scan_everything(spark, folder):
    log = people(spark)
    idx = OffsetIndex.build(spark, folder, log, "Name", UPPER_TRIM, 10)
    assert index.choose([idx], "Other", "$field") is None
    assert index.choose([idx], "Name", "LOWER($field)") is None
    assert index.choose([idx], "Name", "upper( trim($field) )") is not None
    got = lookup(log, "Name", "  name 7", "LOWER($field)", [idx])
    assert offsets(got) == offsets(log.where("LOWER(Name) = '  name 7'"))


@pytest.mark.parametrize("template", ["CONCAT($field, rand())", "now()", "UPPER(Name)"])
def test_refused_templates(spark, folder, template):
    with pytest.raises(ValueError):
        OffsetIndex.build(spark, folder, people(spark), "Name", template)


def test_refresh_reads_new_offsets_only(spark, folder):
    log = people(spark)
    idx = OffsetIndex.build(spark, folder, log.where(f"{OFFSET} < 155"), "Name", "$field", 10)
    assert idx.reached().entries == {0: 153, 1: 154, 2: 152}
    assert idx.refresh(log) == 3 and idx.refresh(log) == 0
    assert idx.reached().entries == {0: 399, 1: 397, 2: 398}
    whole = index.granules(log, "Name", "$field", 10)
    assert idx.entries().exceptAll(whole).count() == 0
    assert idx.entries().count() == whole.count()
    assert offsets(lookup(log, "Name", "  Name 7", "$field", [idx])) == offsets(
        log.where("Name = '  Name 7'"))


def test_null_values_are_not_indexed(spark, folder):
    idx = OffsetIndex.build(spark, folder, people(spark), "Name", "$field", 10)
    assert idx.entries().where("value IS NULL").count() == 0


def test_lookup_over_tiers_prunes_folders_and_row_groups(spark, folder):
    log = people(spark, 1000, 2)
    cold = Table(spark, folder + "/c")
    archive.archive(cold, log.where(f"{OFFSET} < 800").withColumn(
        "kafka_timestamp", F.lit(None).cast("timestamp_ntz")), 100)
    topic = Topic("people", cold=cold, width=100, hot=lambda: log.where(f"{OFFSET} >= 700"))
    idx = OffsetIndex.build(spark, folder + "/i", cold.read(), "Name", "$field", 10)
    found = topic.find("Name", "  Name 7", "$field", [idx])
    assert offsets(found) == offsets(log.where("Name = '  Name 7'"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "offset_bucket" in line and "Pushed" in line)
    assert "offset_bucket" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "kafka_offset" in scan.split("PushedFilters")[1]


def test_late_rows_are_found_before_and_after_a_refresh(spark, folder):
    log = people(spark, 400, 2).withColumn("kafka_timestamp", F.lit(None).cast("timestamp_ntz"))
    cold = Table(spark, folder + "/c")
    archive.archive(cold, log.where(f"{OFFSET} >= 200"), 100)
    topic = Topic("people", cold=cold, width=100)
    idx = OffsetIndex.build(spark, folder + "/i", cold, "Name", "$field", 10)
    archive.append(cold, log)
    want = offsets(log.where("Name = '  Name 7'"))
    assert offsets(topic.find("Name", "  Name 7", "$field", [idx])) == want
    assert idx.refresh(cold) == 2 and idx.refresh(cold) == 0
    assert offsets(topic.find("Name", "  Name 7", "$field", [idx])) == want
    cold.compact()
    assert offsets(topic.find("Name", "  Name 7", "$field", [idx])) == want


def test_effective_predicate_shows_all_ranges(spark, folder):
    log = people(spark, 6000, 1)
    idx = OffsetIndex.build(spark, folder, log.where(f"{OFFSET} % 4 < 2"), "Name", "SUBSTRING($field, 1, 3)", 2)
    shown = index.effective_predicate(idx, "Name", "  N", "SUBSTRING($field, 1, 3)")["effective"]
    assert shown.count(" AND kafka_offset <") > 1000


def test_a_template_that_makes_null_of_the_value_reads_everything(spark, folder):
    cold = Table(spark, folder + "/c")
    archive.archive(cold, people(spark), 100)
    topic = Topic("people", cold=cold, width=100)
    idx = OffsetIndex.build(spark, folder + "/i", cold, "Name", "NULLIF(TRIM($field), 'Name 7')", 2)
    for value in ("  Name 7", "  Name 8"):
        assert offsets(topic.find("Name", value, indexes=[idx])) == offsets(topic.find("Name", value)) != []
    assert {r["low"] for r in idx.explain(idx.probe("$field", "  Name 7")).collect()} == {0}
