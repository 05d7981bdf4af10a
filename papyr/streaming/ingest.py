"""Incremental harvest: new shard files are cut into excerpts as they arrive and appended to the pool, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def harvest(spark: SparkSession, source: str, schema: str, pool: str, checkpoint: str, cut: Callable[[DataFrame], DataFrame], key: str = "doc_index") -> StreamingQuery:
    """A query that runs over the files not seen yet and ends. A batch that is replayed after a failure appends nothing twice, as keys in the pool are left out."""

    def append(batch: DataFrame, number: int) -> None:
        fresh = cut(batch).withColumn("batch", _number(number))
        try:
            held = batch.sparkSession.read.parquet(pool).select(key)
            fresh = fresh.join(held, key, "left_anti")
        except Exception as e:  # the pool doesn't exist before the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(pool)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _number(x: int):
    from pyspark.sql import functions as F

    return F.lit(x)
