"""Settings and intermediate tables of the operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import materialise as stored  # noqa: F401
from pitchlake.session import shared_dir as scratch  # noqa: F401

#: Rows of whole texts in one Arrow batch.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that whole long texts fit beside each other in a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are gone.

    It does so when the driver collects garbage; between the steps of an operator that is too
    rare, and the files of all steps would lie on the executors' disks together.
    """
    for _ in range(2):  # what the first round frees on the driver frees the files in the second
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
