"""Sessions and shared scratch space."""

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "pitchlake", cpus: str = "8", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators count on; safe to set on a running session.

    Hot keys in joins are split even where that costs one more shuffle. A join whose one side is
    small in every partition hashes that side, so the wide rows of the other pass without a sort.
    Where a map is built from repeated keys, the last value stays.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """New folder under the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset, a session of one JVM uses a folder of its own; any other must set it.
    """
    return f"{_own_folder(spark, _base(spark))}/{purpose}-{uuid.uuid4().hex}"


#: Folder of this process where the session names none (the setting is fixed once a session runs).
_fallback: str | None = None


def _base(spark: SparkSession) -> str:
    global _fallback
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="pitchlake-")
    return _fallback


def _own_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/pitchlake-{spark.sparkContext.applicationId}"


def clear_shared(spark: SparkSession) -> None:
    """Remove every intermediate copy of this application; frames that read one end with it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _fallback
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark, base))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The copy survives lost executors, cuts the lineage, and has a known size: joins
    with it are broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffled above it. ``clear_shared`` removes it.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
