"""From raw documents to tokens: five stages, each over all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelog.llm import language_id
from lakelog.llm.bpe import digests
from lakelog.llm.common import stored
from lakelog.llm.decontaminate import find_windows
from lakelog.llm.line_dedup import dedup_lines
from lakelog.llm.simhash_dedup import near_duplicates


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with confidence; learned from three quarters of them."""
    model = language_id.fit(docs.where(language_id.bucket_of("doc_id", 4) != 2))
    found = language_id.identify(docs, model)
    return found.where(~F.col("rejected")).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; ``n_chars`` follows the text."""
    found = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    return found.select(
        *[c for c in docs.columns if c not in ("text", "n_chars")],
        F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"),
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    ).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows that share an id stay or go together, those without stay."""
    gone = near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = find_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("n_hit = 0").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text."""
    return digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenize),
]

ORACLE_SQL = None  # a trained classifier decides in the first stage; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
