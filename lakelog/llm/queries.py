"""One query for each operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakelog.llm import embedding_dedup, hard_negatives, language_id, packing, quality, spelling_variants, suffix_tree_lm, warc
from lakelog.llm.bpe import digests
from lakelog.llm.decontaminate import find_windows
from lakelog.llm.line_dedup import dedup_lines
from lakelog.llm.simhash_dedup import near_duplicates
from lakelog.llm.substring_dedup import remove_repeats
from lakelog.sources.workdir import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _told(held_out: Column) -> Column:
    """The flag as a result: rows without an id, which teach nothing either, are not held out."""
    return F.coalesce(held_out, F.lit(False)).alias("held_out")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = language_id.bucket_of("doc_id", 4) == 2
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", _told(held_out), "lang_pred", "score", "rejected")


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    train = language_id.bucket_of("doc_id", 5) != 1
    tree = suffix_tree_lm.fit(docs.where(train))
    found = suffix_tree_lm.score(docs, tree, train)
    return found.withColumn("held_out", _told(~train))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    found = warc.read(spark, folder, with_payload=False)
    page = lambda c: F.regexp_extract(c, "^urn:page:(.+)$", 1).cast("long")
    return found.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_windows(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"), keep_text=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = language_id.bucket_of("doc_id", 5) == 0
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out)
    found = quality.score(docs, quality.fit(docs, labels), keep_text=False)
    return found.select("doc_id", _told(held_out), "score", "predicted")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector against all; every seventh has its label moved on by one first."""
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as word tokens in sequences of at most 2,048."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents; one run of letters in 97 of a document loses a letter first."""
    words = spelling_variants.count_words(_table(spark, sf_dir, "documents", "doc_id", "text"), damage=97)
    return spelling_variants.group(words.where((F.length("word") >= 5) & (F.col("n") >= 3)))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_tree_lm": op2_suffix_tree_lm,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
