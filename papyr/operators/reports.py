"""Reports on categories, labels, grades and judges; each is one aggregation with partial results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyr.functions import signals as S
from papyr.operators.stats import exact_percentiles, warning_cap


def category_profile(meta: DataFrame, category: str, confidence: str, year: str, size: str) -> DataFrame:
    """(category, documents, confidence_min, confidence_p50, suspect, year_min, year_p50, year_max, size_p50, size_p90) by category, null ones included.

    Percentiles are values of the data at place int(q * (n - 1)); ``suspect`` counts confidences below 0.5. Nulls count in no statistic.
    """
    own = meta.groupBy(category).agg(
        F.count(F.lit(1)).alias("documents"), F.min(confidence).alias("confidence_min"), F.count_if(F.col(confidence) < 0.5).alias("suspect"), F.min(year).alias("year_min"), F.max(year).alias("year_max"),
    )
    for value, points in ((confidence, {"confidence_p50": 0.5}), (year, {"year_p50": 0.5}), (size, {"size_p50": 0.5, "size_p90": 0.9})):
        part = exact_percentiles(meta, [category], value, points).drop("n").withColumnRenamed(category, "_c")
        own = own.join(part, F.col(category).eqNullSafe(F.col("_c")), "left").drop("_c")
    return own


def relabel(excerpts: DataFrame, text: str = "excerpt", label: str = "affordance") -> DataFrame:
    """``excerpts`` with ``relabelled``: the label that the routing rules give now. Null texts have none."""
    return excerpts.withColumn("relabelled", S.affordance_label(F.col(text)))


def relabel_delta(relabelled: DataFrame, label: str = "affordance") -> DataFrame:
    """(before, after, n): how many labels the rules change, and to what; null is a label of its own."""
    changed = relabelled.where(~F.col(label).eqNullSafe(F.col("relabelled")))
    return changed.groupBy(F.col(label).alias("before"), F.col("relabelled").alias("after")).agg(F.count(F.lit(1)).alias("n"))


def grade_analysis(rows: DataFrame, by: str, score: str = "score", warnings: str = "warnings") -> DataFrame:
    """(by, subset, n, mean, median, low, high, b90, b75, b50, below50) of all scored rows, the clean, the flagged, and those their warnings cap.

    The median is the middle value or the mean of both middle ones. Null scores don't count; null warnings are none.
    """
    w = F.coalesce(F.col(warnings), F.array().cast("array<string>"))
    subsets = F.array(F.lit("all"), F.when(F.size(w) == 0, "clean").otherwise("flagged"), F.when(warning_cap(w) < 100, "capped"))
    s = F.col(score)
    each = rows.where(s.isNotNull()).select(by, score, F.explode(F.filter(subsets, lambda x: x.isNotNull())).alias("subset"))
    return each.groupBy(by, "subset").agg(
        F.count(F.lit(1)).alias("n"), F.bround(F.avg(s), 1).alias("mean"), F.percentile(s, 0.5).alias("median"), F.min(s).alias("low"), F.max(s).alias("high"),
        F.count_if(s >= 90).alias("b90"), F.count_if((s >= 75) & (s < 90)).alias("b75"), F.count_if((s >= 50) & (s < 75)).alias("b50"), F.count_if(s < 50).alias("below50"),
    )


def warning_histogram(rows: DataFrame, by: str, score: str = "score", warnings: str = "warnings") -> DataFrame:
    """(by, warning, n): how often each defect is named among scored rows; what follows a colon tells one case and falls away."""
    each = rows.where(F.col(score).isNotNull()).select(by, F.explode(warnings).alias("w"))
    return each.groupBy(by, F.substring_index("w", ":", 1).alias("warning")).agg(F.count(F.lit(1)).alias("n"))


def judge_summary(judged: DataFrame, by: str) -> DataFrame:
    """(by, n, answered, period, both4, answered2, period2): means of a judge's two marks, and the shares of rows with both at 4 or more, and with either at 2 or less."""
    rows = judged.where(F.col("answered").isNotNull() & F.col("period").isNotNull())
    share = lambda c: F.bround(F.count_if(c) / F.count(F.lit(1)), 6)
    a, p = F.col("answered"), F.col("period")
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.bround(F.avg(a), 6).alias("answered"), F.bround(F.avg(p), 6).alias("period"), share((a >= 4) & (p >= 4)).alias("both4"), share(a <= 2).alias("answered2"), share(p <= 2).alias("period2"),
    )
