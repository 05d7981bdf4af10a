"""Sources and sinks: whole texts, JSON folders, shards with a manifest, ledgers of what was pushed, versions of a pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TURNS = "conversations array<struct<role:string,content:string>>, chained boolean, enriched boolean, recovered boolean, flagged boolean, changed boolean, score double"


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, text) of text files read whole; the dataset is the file's name without its ending."""
    return spark.read.text(path, wholetext=True).select(stem(F.input_file_name()).alias("dataset"), F.col("value").alias("text"))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def json_rows(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    """Rows of JSON arrays (``lines`` false) or of JSON lines, with ``dataset`` from the file's name."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path).withColumn("dataset", stem(F.input_file_name()))


def pairs_of_conversations(rows: DataFrame, order: str = "i") -> DataFrame:
    """(dataset, i, q, a): each conversation's first user turn and first assistant turn; rows without either are left out."""
    first = lambda role: F.get(F.filter("conversations", lambda t: t["role"] == role), F.lit(0))["content"]
    got = rows.select("dataset", order, first("user").alias("q"), first("assistant").alias("a"))
    return got.where(F.col("q").isNotNull() & F.col("a").isNotNull())


def offsets(manifest: DataFrame) -> DataFrame:
    """(index, num_docs, start): where each shard begins in the global numbering. A manifest is a small table, one row a shard."""
    w = Window.partitionBy(F.lit(0)).orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("num_docs").over(w), F.lit(0).cast("long")))


def locate(rows: DataFrame, number: str, starts: DataFrame) -> DataFrame:
    """``rows`` with ``shard`` and ``local`` row of a global number; numbers beyond the last shard have null. The offsets are one row a shard, broadcast."""
    s = F.broadcast(starts.select(F.col("index").alias("shard"), "start", (F.col("start") + F.col("num_docs")).alias("_end")))
    return rows.join(s, (F.col(number) >= F.col("start")) & (F.col(number) < F.col("_end")), "left").withColumn("local", F.col(number) - F.col("start")).drop("start", "_end")


def misaligned_shards(meta: DataFrame, manifest: DataFrame) -> DataFrame:
    """(shard, expected, found) of shards whose metadata rows are not as many as the manifest says."""
    found = meta.groupBy("shard").agg(F.count(F.lit(1)).alias("found"))
    return manifest.select(F.col("index").alias("shard"), F.col("num_docs").alias("expected")).join(found, "shard", "full").where(~F.col("expected").eqNullSafe(F.col("found"))).select("shard", F.coalesce("expected", F.lit(0).cast("long")).alias("expected"), F.coalesce("found", F.lit(0).cast("long")).alias("found"))


def load_excerpts(pool: DataFrame, affordance: str | None = None, classes: list[str] | None = None, floor: float = 0.0, sound_math: bool = False) -> DataFrame:
    """The excerpts of a pool by affordance, any of the classes, prose score (null counts 0) and sound formulas."""
    from papyr.functions.signals import has_broken_math

    out = pool
    if affordance is not None:
        out = out.where(F.col("affordance") == affordance)
    if classes is not None:
        out = out.where(F.arrays_overlap("classes", F.array(*map(F.lit, classes))))
    if floor > 0:
        out = out.where(F.coalesce("prose_score", F.lit(0.0)) >= floor)
    return out.where(~has_broken_math(F.col("excerpt"))) if sound_math else out


def not_pushed(rows: DataFrame, key: str, pushed: DataFrame, complete: Column) -> DataFrame:
    """The complete rows that the ledger of pushed keys (column ``key``) doesn't hold."""
    return rows.where(complete).join(pushed.select(F.col("key").alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")


def write_by_dataset(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("dataset").json(path)


def write_sharded(rows: DataFrame, path: str, order: str, shard_rows: int = 2000) -> None:
    """Everything under ``path`` replaced by files of at most ``shard_rows`` rows, in order."""
    rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").option("maxRecordsPerFile", shard_rows).json(path)


def compact(spark: SparkSession, source: str, target: str, schema: str, order: str, shard_rows: int = 2000) -> None:
    """Many small files rewritten as even ones, at another path: a path is never read and replaced at once."""
    write_sharded(spark.read.schema(schema).json(source), target, order, shard_rows)


def migrate(rows: DataFrame, dropped: list[str]) -> DataFrame:
    return rows.drop(*dropped)
