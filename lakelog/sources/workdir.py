"""Where intermediate tables go: the shared folder named by the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="lakelog-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/lakelog/{app}/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder."""
    from lakelog.sources.files import Files

    Files(spark).delete(f"{shared_root(spark)}/lakelog/{spark.sparkContext.applicationId}")
