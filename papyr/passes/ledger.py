"""The verdict ledger: (pass, key, payload, version), appended to, the latest version of a key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "pass string, key string, payload string, version int"


def latest(ledger: DataFrame, name: str) -> DataFrame:
    """(key, payload): the last verdict of each key in a pass. Of equal versions the greatest payload counts; null keys have none."""
    own = ledger.where((F.col("pass") == name) & F.col("key").isNotNull())
    return own.groupBy("key").agg(F.max(F.struct("version", "payload")).alias("_v")).select("key", F.col("_v.payload").alias("payload"))


def pending(rows: DataFrame, key: str, ledger: DataFrame, name: str) -> DataFrame:
    """The rows without a verdict yet."""
    done = ledger.where((F.col("pass") == name) & F.col("key").isNotNull()).select(F.col("key").alias("_k")).distinct()
    return rows.join(done, F.col(key) == F.col("_k"), "left_anti")


def with_verdict(rows: DataFrame, key: str, ledger: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``payload``, null where there is no verdict."""
    v = latest(ledger, name).select(F.col("key").alias("_k"), "payload")
    return rows.join(v, F.col(key) == F.col("_k"), "left").drop("_k")


def without_keys(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not among those dropped (column ``key``)."""
    return rows.join(dropped.select(F.col("key").alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")
