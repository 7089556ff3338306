"""Sets of offsets as bitmaps: one row for each log partition and slot of 32,768 offsets that has any.

Bitmaps are built before the shuffle, so a row of a log is never shuffled by its offset to find out whether it is
known. A set of a partition without gaps takes a bit for each offset, whatever its rows hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelog.functions.coords import OFFSET, PARTITION

SLOT, BITMAP = "slot", "bitmap"
SIZE = 32_768  # offsets in a slot, as Spark's bitmap functions have it


def build(rows: DataFrame, *within: str) -> DataFrame:
    """(*within, slot, bitmap, low, high, rows): the offsets of ``rows``, by log partition if ``within`` is left out.

    ``rows`` counts repeats, the bitmap does not. Rows without an offset are in no set.
    """
    keys = within or (PARTITION,)
    found = rows.where(f"{OFFSET} IS NOT NULL").select(*keys, OFFSET, F.bitmap_bucket_number(OFFSET).alias(SLOT))
    return found.groupBy(*keys, SLOT).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(OFFSET)).alias(BITMAP),
        F.min(OFFSET).alias("low"),
        F.max(OFFSET).alias("high"),
        F.count(F.lit(1)).alias("rows"),
    )


def slot_of(offset: int) -> int:
    """The slot of an offset, as ``bitmap_bucket_number`` gives it."""
    return 1 + (offset - 1) // SIZE if offset > 0 else -(-offset // SIZE)


def end_of(slot: int) -> int:
    """The first offset after a slot."""
    return slot * SIZE + 1


def unite(sets: DataFrame) -> DataFrame:
    """(partition, slot, bitmap) of all offsets that any of the sets holds."""
    return sets.groupBy(PARTITION, SLOT).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def _holds(bitmap: Column) -> Column:
    """Whether the bitmap of its slot has the bit of the row's offset."""
    at = f"CAST(bitmap_bit_position({OFFSET}) AS INT)"
    byte = F.conv(F.hex(F.substring(bitmap, F.expr(f"{at} DIV 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.expr(f"shiftleft(1, {at} % 8)")) != 0


def _met(rows: DataFrame, sets: DataFrame) -> DataFrame:
    known = unite(sets).toDF("__partition", "__slot", "__bitmap")
    same = (F.col(PARTITION) == F.col("__partition")) & (F.bitmap_bucket_number(OFFSET) == F.col("__slot"))
    return rows.join(known, same, "left")


def outside(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows whose offset none of the sets holds; rows without an offset or a partition are outside."""
    return _met(rows, sets).where(~F.coalesce(_holds(F.col("__bitmap")), F.lit(False))).select(*rows.columns)


def inside(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows whose offset one of the sets holds."""
    return _met(rows, sets).where(F.coalesce(_holds(F.col("__bitmap")), F.lit(False))).select(*rows.columns)


# Offsets of a bitmap in order. Slots up to 0 count downwards.
_BITS = (
    "FLATTEN(TRANSFORM(SEQUENCE(0, 4095), i -> TRANSFORM(FLATTEN(TRANSFORM("
    f"ARRAY(CAST(CONV(HEX(SUBSTRING({BITMAP}, i + 1, 1)), 16, 10) AS INT)), "
    "v -> FILTER(SEQUENCE(0, 7), b -> (SHIFTRIGHT(v, b) & 1) = 1))), b -> i * 8 + b)))"
)
_PRESENT = (
    f"IF({SLOT} > 0, TRANSFORM({_BITS}, p -> ({SLOT} - 1) * {SIZE}L + 1 + p), "
    f"REVERSE(TRANSFORM({_BITS}, p -> {SLOT} * {SIZE}L - p)))"
)
_WHOLE = f"ARRAY(({SLOT} - 1) * {SIZE}L + 1, {SLOT} * {SIZE}L)"  # only its ends: nothing is missing between
_INNER = (
    "FILTER(ZIP_WITH(SLICE(present, 1, SIZE(present) - 1), SLICE(present, 2, SIZE(present) - 1), "
    "(x, y) -> STRUCT(x + 1 AS gap_start, y - 1 AS gap_end)), g -> g.gap_start <= g.gap_end)"
)


def gaps(sets: DataFrame) -> DataFrame:
    """(partition, gap_start, gap_end): ranges between the lowest and the highest offset of a partition that no set holds.

    Only bitmaps with holes are opened. What is ordered is a row of a slot, and not of an offset.
    """
    known = unite(sets)
    whole = (F.col(SLOT) > 0) & (F.bitmap_count(BITMAP) == SIZE)
    slots = (
        known.withColumn("present", F.when(whole, F.expr(_WHOLE)).otherwise(F.expr(_PRESENT)))
        .select(
            PARTITION, SLOT, F.element_at("present", 1).alias("first"), F.element_at("present", -1).alias("last"),
            F.when(whole, F.expr("ARRAY()").cast("array<struct<gap_start:bigint,gap_end:bigint>>"))
            .otherwise(F.expr(_INNER)).alias("inner"),
        )
    )
    before = F.lag("last").over(Window.partitionBy(PARTITION).orderBy(SLOT))
    ahead = F.struct((before + 1).alias("gap_start"), (F.col("first") - 1).alias("gap_end"))
    ranges = slots.select(PARTITION, F.concat(F.array(ahead), "inner").alias("ranges"))
    return ranges.select(PARTITION, F.inline("ranges")).where("gap_start <= gap_end")
