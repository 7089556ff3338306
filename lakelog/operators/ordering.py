"""Order-sensitive work on whole logs without a single-task window.

Rows are cut into chunks of bounded size; each chunk is handled by itself, and
only one small row per chunk carries what the next chunk needs to know.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.functions.coords import OFFSET, PARTITION, TIMESTAMP, block_start
from lakelog.sources.files import Files
from lakelog.sources.workdir import new_folder

CHUNK, ROW = "__chunk", "__row"
LITERAL_BASES = 256
CHUNK_BYTES = 256 << 20
UNKNOWN_BYTES = 1 << 60
_ROW_BITS = 33  # monotonically_increasing_id: task number above, row in the task below


def with_previous(
    df: DataFrame, keys: list[str], values: list[str], width: int = 1_000_000,
    time_block: str | None = None,
) -> DataFrame:
    """Add ``previous``: ``values`` of the row before, per key and log partition.

    With ``time_block`` the row before is the one of the key in time, over all log
    partitions, with the coordinates for equal times.

    A key may own any share of the log, so the window runs per block of
    ``width`` offsets, or of that unit of time. The last row of a key in a block is added to that key's
    next block as a marker row ahead of its offsets.
    """
    cut = list(dict.fromkeys([*keys, *([] if time_block else [PARTITION])]))
    block, payload = "__block", F.struct(*values)
    steps = [TIMESTAMP, PARTITION, OFFSET] if time_block else [OFFSET]
    data = df.withColumn(block, F.date_trunc(time_block, TIMESTAMP) if time_block else block_start(OFFSET, width))
    lasts = data.groupBy(*cut, block).agg(F.max_by(payload, F.struct(*steps)).alias("__carry"))
    following = Window.partitionBy(*cut).orderBy(block)
    markers = (
        lasts.withColumn("__next", F.lead(block).over(following))
        .where(F.col("__next").isNotNull())
        .select(*cut, F.col("__next").alias(block), "__carry", F.lit(True).alias("__marker"))
    )
    rows = data.withColumn("__carry", payload).withColumn("__marker", F.lit(False))
    everything = rows.unionByName(markers, allowMissingColumns=True)
    inside = Window.partitionBy(*cut, block).orderBy(F.desc("__marker"), *steps)
    return (
        everything.withColumn("previous", F.lag("__carry").over(inside))
        .where(~F.col("__marker"))
        .select(*df.columns, "previous")
    )


@dataclass
class Ordered:
    """A table written in range order: one folder per chunk, rows numbered in it.

    ``bases`` has one (chunk, rows before it) pair per write task, which
    ``range_tasks`` bounds.
    """

    folder: str
    schema: T.StructType
    bases: list[tuple[int, int]]
    rows: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.folder)

    def numbered(self, df: DataFrame, name: str, start: int = 0) -> DataFrame:
        """All rows of ``df = self.read(..)`` with their number in ``name``."""
        if len(self.bases) <= LITERAL_BASES:
            whens = " ".join(f"WHEN {c} THEN {start + base}L" for c, base in self.bases)
            number = f"CASE {CHUNK} {whens} END + {ROW}" if whens else f"{ROW}"
            return df.withColumn(name, F.expr(number)).drop(CHUNK, ROW)
        bases = df.sparkSession.createDataFrame(self.bases, "`__c` int, `__base` bigint")
        joined = df.join(F.broadcast(bases), F.col(CHUNK) == F.col("__c"))
        return joined.withColumn(name, F.col("__base") + F.col(ROW) + F.lit(start)).drop(
            CHUNK, ROW, "__c", "__base")

    def slice(self, df: DataFrame, name: str, low: int, high: int, start: int = 0) -> DataFrame:
        """The rows numbered ``low`` to ``high - 1``.

        Chunks are folders and rows are sorted in them, so only the folders and
        row groups of the slice are read. Each chunk is one branch: a condition
        on the row alone reaches the scan.
        """
        lo, hi = max(low - start, 0), min(high - start, self.rows)
        ends = [b for _, b in self.bases[1:]] + [self.rows]
        hits = [(c, b, e) for (c, b), e in zip(self.bases, ends, strict=True) if b < hi and e > lo]
        whole = [h for h in hits if lo <= h[1] and h[2] <= hi]
        partial = [h for h in hits if h not in whole]
        branches = [
            self.numbered(df.where(f"{CHUNK} = {c} AND {ROW} >= {lo - b} AND {ROW} < {hi - b}"),
                          name, start)
            for c, b, _ in partial
        ]
        if whole:
            first, last = whole[0][0], whole[-1][0]
            branches.append(
                self.numbered(df.where(f"{CHUNK} BETWEEN {first} AND {last}"), name, start))
        if not branches:
            return self.numbered(df.where("FALSE"), name, start)
        return reduce(DataFrame.unionByName, branches)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as far as the optimizer knows them.

    Sources of unknown size report an absurdly large one and do not count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def range_tasks(df: DataFrame) -> int:
    """Range partitions for ``df``: the session's shuffle width, or more if the
    input would make them larger than ``CHUNK_BYTES``."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-input_bytes(df) // CHUNK_BYTES))


def write_ordered(df: DataFrame, order: list[Column], label: str,
                  folder: str | None = None) -> Ordered:
    """Range-partition and sort ``df``, and keep the result in a shared folder.

    The chunk borders come from sampling, so they are fixed by writing the rows
    once: every later step sees the same chunks, also after an executor is lost.
    """
    spark = df.sparkSession
    tasks = range_tasks(df)
    folder = folder or new_folder(spark, label)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    (
        df.repartitionByRange(tasks, *order)
        .withColumn(CHUNK, F.spark_partition_id())
        .sortWithinPartitions(CHUNK, *order)
        .withColumn(ROW, row)
        .write.partitionBy(CHUNK).parquet(folder)
    )
    schema = T.StructType([
        *df.schema, T.StructField(ROW, T.LongType()), T.StructField(CHUNK, T.IntegerType()),
    ])
    if CHUNK not in {n.split("=")[0] for n in Files(spark).names(folder)}:
        return Ordered(folder, schema, [], 0)
    counted = spark.read.schema(schema).parquet(folder).groupBy(CHUNK).agg(
        F.count(F.lit(1)).alias("n"))
    bases, total = [], 0
    for r in sorted(counted.collect(), key=lambda r: r[CHUNK]):
        bases.append((r[CHUNK], total))
        total += r["n"]
    return Ordered(folder, schema, bases, total)


def dense_number(
    df: DataFrame, order: list[Column], name: str, start: int = 0, label: str = "numbered"
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in ``order`` without gaps.

    ``order`` has to be total (add the coordinates as tie-breakers), so that the
    numbering is the same on every run.
    """
    ordered = write_ordered(df, order, label)
    return ordered.numbered(ordered.read(df.sparkSession), name, start)


def pick_ranks(
    df: DataFrame, group: str, value: str, ranks: dict[str, Column]
) -> DataFrame:
    """Exact order statistics per group: for each name the value at a 0-based rank.

    Each rank is an expression over ``n``, the group's number of rows. Equal
    values are counted together first; a group of any size is then spread over
    range chunks, and the counts that precede a chunk are carried by one small
    row per chunk.
    """
    spark = df.sparkSession
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("g"), F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("k"))
    )
    ordered = write_ordered(counts, [F.col("g"), F.col("v")], "ranks")
    rows = ordered.read(spark).withColumnRenamed(CHUNK, "c")
    edges = (
        rows.groupBy("c", "g").agg(F.sum("k").alias("k"))
        .groupBy("c")
        .agg(F.min(F.struct("g", "k")).alias("first"), F.max(F.struct("g", "k")).alias("last"))
    )
    carry = _carry(sorted(edges.collect(), key=lambda r: r["c"]))
    gtype = counts.schema["g"].dataType.simpleString()
    table = spark.createDataFrame(
        carry,
        f"c int, fg {gtype}, before bigint, ftotal bigint, lg {gtype}, ltotal bigint",
    )
    local = Window.partitionBy("c", "g")
    running = local.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("upto", F.sum("k").over(running))
        .withColumn("inside", F.sum("k").over(local))
        .join(F.broadcast(table), "c")
        .withColumn("upto", F.col("upto") + F.when(F.col("g").eqNullSafe(F.col("fg")), F.col("before")).otherwise(0))
        .withColumn(
            "n",
            F.when(F.col("g").eqNullSafe(F.col("fg")), F.col("ftotal"))
            .when(F.col("g").eqNullSafe(F.col("lg")), F.col("ltotal"))
            .otherwise(F.col("inside")),
        )
    )
    here = {
        name: (rank >= F.col("upto") - F.col("k")) & (rank < F.col("upto"))
        for name, rank in ranks.items()
    }
    return placed.groupBy(F.col("g").alias(group)).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(cond, F.col("v"))).alias(name) for name, cond in here.items()],
    )


def _carry(edges: list) -> list[tuple]:
    """Per chunk: first group, its rows in earlier chunks, and both border totals."""
    totals: dict = {}
    before = []
    for e in edges:
        first, last = e["first"], e["last"]
        before.append(totals.get(first["g"], 0))
        totals[first["g"]] = totals.get(first["g"], 0) + first["k"]
        if last["g"] != first["g"]:
            totals[last["g"]] = totals.get(last["g"], 0) + last["k"]
    return [
        (e["c"], e["first"]["g"], b, totals[e["first"]["g"]], e["last"]["g"], totals[e["last"]["g"]])
        for e, b in zip(edges, before, strict=True)
    ]
