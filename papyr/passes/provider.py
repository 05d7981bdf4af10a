"""Providers turn requests (batch_id, pos, key, prompt) into replies (batch_id, body).

The replay provider joins recorded replies; the rule provider computes them with column expressions. A provider
that calls a service would do so in ``mapInPandas`` and is not part of this library.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Provider(Protocol):
    def replies(self, requests: DataFrame) -> DataFrame: ...


class Replay:
    """Recorded replies (batch_id, body); a batch without one has none."""

    def __init__(self, recorded: DataFrame):
        self.recorded = recorded

    def replies(self, requests: DataFrame) -> DataFrame:
        return self.recorded.join(requests.select("batch_id").distinct(), "batch_id", "left_semi").select("batch_id", "body")


class Rule:
    """Replies computed for each request, put together as one JSON array per batch in the order of ``pos``."""

    def __init__(self, rule: Callable[[DataFrame], Column]):
        self.rule = rule

    def replies(self, requests: DataFrame) -> DataFrame:
        item = F.struct("pos", self.rule(requests).cast("string").alias("v"))
        rows = requests.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("_r"))
        return rows.select("batch_id", F.concat(F.lit("["), F.array_join(F.transform("_r", lambda r: r["v"]), ","), F.lit("]")).alias("body"))
