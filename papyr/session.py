"""Session helpers: reading tables, materialising intermediate tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The parquet table ``name`` below the folder ``base``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as there are cores, where its files give fewer; for work that costs far more than the move. Large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by all executors that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without: then a local folder is used, and set. On a cluster a folder of one
    machine would lose rows, so a missing name is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "papyr-checkpoints"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, in the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_written: dict[str, list[str]] = {}  # by application, the intermediate tables that still exist
_lock = threading.Lock()


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of queries whose results have been written or collected; gives their number.

    A query's result reads them, so only the caller knows when it is done with it.
    """
    with _lock:
        gone = _written.pop(spark.sparkContext.applicationId, [])
    for path in gone:
        fs, p = _files(spark, path)
        fs.delete(p, True)
    return len(gone)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as compressed parquet to the shared folder and read again.

    It cuts the lineage, outlives the loss of executors, and lets several later jobs share the work.
    :func:`drop_scratch` deletes the tables, and what is left goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/papyr-{label}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    with _lock:
        _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    fs, p = _files(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)
