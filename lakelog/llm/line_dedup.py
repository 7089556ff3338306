"""Line dedup: explode normalised lines, hash them, count distinct documents per hash, drop, reassemble.

DataFrame functions only. The text itself never goes through the line shuffle: lines travel as two 64-bit
hashes with their position, and come back as one list of dropped positions per document. Counting combines before
the shuffle, and the lines of one key are looked up in several tasks, so a very common line is no bottleneck.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelog.llm.common import salted_join

BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case.

    ``lower`` is the fast way and the same thing where a line is plain ASCII.
    """
    bare = F.btrim(line, F.lit(BLANK))
    folded = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(folded)


def _digest(value: Column) -> list[Column]:
    """128 bits, as two differently seeded hashes."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """Columns of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept`` (the remaining text).

    A key of ``min_chars`` code points or more that ``min_docs`` documents hold loses all its lines but
    those of the smallest id. Null and empty texts are one empty line. A row with a null id is kept as it is
    and counts for nothing. Rows that share an id are one document to the count, and each keeps its own text;
    the first holder keeps every line in all its rows. Columns of ``docs`` with the names of results are
    replaced.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")])
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    base = docs.select(row.alias("row"), docs[f"`{id_col}`"].alias("id"), text.alias("text"))
    t1, t2 = _digest(F.col("text"))
    narrow = base.where("id is not null").select("id", t1.alias("t1"), t2.alias("t2"), "text")

    line = narrow.select("id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = line.select("id", "t1", "t2", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.length("key") >= min_chars)
    k1, k2 = _digest(F.col("key"))
    keyed = keyed.select("id", "t1", "t2", "pos", k1.alias("k1"), k2.alias("k2"))

    if min_docs == 2:  # two documents hold it: the smallest id is not the largest
        shared = keyed.groupBy("k1", "k2").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
        shared = shared.where("owner <> last")
    else:
        shared = keyed.groupBy("k1", "k2").agg(F.min("id").alias("owner"), F.count_distinct("id").alias("n"))
        shared = shared.where(F.col("n") >= min_docs)
    dropped = (
        salted_join(keyed, shared.select("k1", "k2", "owner"), ["k1", "k2"], "id")
        .where("id <> owner")
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set("pos").alias("gone"))
    )

    all_docs = base.select("row", "id", "text", t1.alias("t1"), t2.alias("t2"))
    joined = all_docs.join(dropped.hint("shuffle_hash"), ["id", "t1", "t2"], "left")
    lines = F.split("text", "\n", -1)
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\n')")
    return (
        joined.withColumn("lines", lines)
        .withColumn("kept", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept))
        .select(
            "row.*",
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
            "kept",
        )
    )
