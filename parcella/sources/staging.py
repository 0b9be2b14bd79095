"""Stored intermediates: cut lineage where a frame feeds several passes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where the setting is absent (local tests) is a temporary folder made.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This runs a job. The stored table survives lost executors, gives later
    passes column pruning and pushed filters, and its real size lets Spark
    decide what to broadcast. It is deleted when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop ``path`` when the driver's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def spread(df: DataFrame) -> DataFrame:
    """Repartition a source that arrives in fewer pieces than there are cores.

    For small or unsplittable files ahead of heavy per-row work; a large table
    already has more splits than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
