"""The catalogue of the engine's queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyr.functions import signals as S
from papyr.operators.windows import pinned
from papyr.plans import pool_queries, report_queries, signal_sql, text_queries
from papyr.session import spread, table


def flagship(spark: SparkSession, base: str) -> DataFrame:
    """(lang, affordance, documents, quality): what kinds of prose the documents hold, by label, after furniture lines are taken out."""
    docs = pinned(spread(table(spark, base, "documents").where(F.col("text").isNotNull()).select("lang", "text")), clean=S.strip_lines(F.col("text")))
    good = docs.where(~S.is_garbage(F.col("clean"))).select("lang", S.affordance_label(F.col("clean")).alias("affordance"), S.region_quality(F.col("clean")).alias("quality"))
    return good.groupBy("lang", "affordance").agg(F.count(F.lit(1)).alias("documents"), F.bround(F.avg("quality"), 3).alias("quality"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"flagship": flagship} | text_queries.QUERIES | pool_queries.QUERIES | report_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return text_queries.SQL | pool_queries.SQL | signal_sql.SQL | report_queries.SQL
