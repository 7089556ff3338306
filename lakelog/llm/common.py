"""Intermediate tables of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelog.sources.workdir import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: computed once, lineage cut."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SALTS = 16


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, how: str = "inner") -> DataFrame:
    """Join ``left`` with one row per key of ``right``, a key's rows of ``left`` going to SALTS tasks.

    ``spread`` is a column of ``left`` that differs among the rows of a key; ``right`` is replicated, so it should
    be narrow. ``how`` is inner, left or left_semi.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.withColumn("salt", salt).join(copies, [*keys, "salt"], how).drop("salt")
