"""Live logs as folders of files, read whole or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_log(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """The log as of now. Without ``schema`` the union of all files' fields is used."""
    if schema is not None:
        return spark.read.schema(schema).parquet(folder)
    return spark.read.option("mergeSchema", "true").parquet(folder)


def stream_log(spark: SparkSession, folder: str, schema: T.StructType,
               files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def decode_payload(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Replace a JSON payload by the typed fields of its registered record schema.

    A payload that does not fit gives null fields; the row stays.
    """
    names = schema.names if isinstance(schema, T.StructType) else \
        T._parse_datatype_string(schema).names
    rest = [c for c in df.columns if c != column]
    decoded: Column = F.from_json(F.col(column), schema)
    return df.withColumn("__record", decoded).select(
        *rest, *[F.col(f"__record.{n}").alias(n) for n in names]
    )
