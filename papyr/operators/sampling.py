"""Seeded samples, quotas and pools. Every draw is a function of seed and key, so it is the same under any partitioning and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyr.operators.windows import draw


def seeded_order(key: Column, seed: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample(rows: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows in seeded order: each partition keeps its first n, so nothing is sorted as a whole."""
    return rows.withColumn("_o", seeded_order(F.col(key), seed)).orderBy("_o", key).limit(n).drop("_o")


def tempered_quotas(eligible: DataFrame, total: int, alpha: float = 0.5, category: str = "category", n: str = "n") -> DataFrame:
    """``eligible`` (category, n) with ``quota``: the total shared out by n to the power alpha, rounded half to even, none above n."""
    power = F.when(F.col(n) > 0, F.pow(F.col(n).cast("double"), F.lit(alpha))).otherwise(0.0)
    every = eligible.agg(F.sum(power).alias("_w"))
    return eligible.join(F.broadcast(every)).withColumn("quota", F.when(F.col(n) > 0, F.least(F.bround(total * power / F.col("_w"), 0).cast("long"), F.col(n))).otherwise(F.lit(0).cast("long"))).drop("_w")


def fill_quotas(rows: DataFrame, quotas: DataFrame, category: str, key: str, seed: int = 0) -> DataFrame:
    """Of each category its first ``quota`` rows in seeded order. The filter on the rank lets every partition drop all but so many before the shuffle."""
    most = quotas.agg(F.max("quota").alias("m")).collect()[0]["m"] or 0
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(category).orderBy(seeded_order(F.col(key), seed), key))).where(F.col("_r") <= int(most))
    return ranked.join(F.broadcast(quotas.select(F.col(category), "quota")), category).where(F.col("_r") <= F.col("quota")).drop("_r", "quota")


def two_slices(rows: DataFrame, key: str, first: float = 0.45, second: float = 0.30, seed: int = 0) -> DataFrame:
    """``rows`` with ``in_first`` and ``in_second``: the seeded order up to the fraction ``first``, and from ``second`` on, which overlap.

    Ranks need no sort of the whole: 4096 buckets of the hash are counted, and only the two that hold a bound are ranked.
    """
    bucket = F.conv(F.substring(F.col("_o"), 1, 3), 16, 10).cast("int")
    rows = rows.withColumn("_o", seeded_order(F.col(key), seed)).withColumn("_b", bucket)
    counts = {r["_b"]: r["n"] for r in rows.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    run, bounds = 0, []
    for goal in (int(n * first), int(n * second)):
        run = 0
        for b in range(4096):
            if run + counts.get(b, 0) > goal:
                break
            run += counts.get(b, 0)
        bounds.append((b, goal - run))
    (b1, k1), (b2, k2) = bounds
    edge = F.col("_b").isin(b1, b2)
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_o", key))
    ranked = rows.where(edge).withColumn("_r", rank).unionByName(rows.where(~edge).withColumn("_r", F.lit(0)))
    one = (F.col("_b") < b1) | ((F.col("_b") == b1) & (F.col("_r") <= k1))
    two = (F.col("_b") > b2) | ((F.col("_b") == b2) & (F.col("_r") > k2))
    return ranked.withColumns({"in_first": one, "in_second": two}).drop("_o", "_b", "_r")


def weighted_choice(u: Column, options: dict[str, float]) -> Column:
    """The option in whose share of the weights a number in [0, 1) falls."""
    total = sum(options.values())
    out, run = F.lit(list(options)[-1]), 0.0
    bounds = []
    for name, w in options.items():
        run += w / total
        bounds.append((name, run))
    for name, upto in reversed(bounds[:-1]):
        out = F.when(u < upto, name).otherwise(out)
    return out


def target_exchanges(key: Column, seed: int = 0) -> Column:
    """2 to 5 exchanges for a document, in 46, 31, 11.5 and 11.5 percent of cases."""
    return weighted_choice(draw(key, "exchanges", None, seed), {"2": 46, "3": 31, "4": 11.5, "5": 11.5}).cast("int")


def mismatched(rows: DataFrame, key: str, answer: str = "answer", seed: int = 0) -> DataFrame:
    """``rows`` with ``other``, the answer of another row: the two seeded orders are joined rank by rank within hash buckets, and equal answers fall out."""
    bucket = F.substring(F.md5(F.concat(F.lit("bucket:"), F.col(key).cast("string"))), 1, 3)
    a = rows.withColumn("_b", bucket).withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(seeded_order(F.col(key), seed), key)))
    b = rows.select(F.col(answer).alias("other"), bucket.alias("_b"), F.row_number().over(Window.partitionBy(bucket).orderBy(seeded_order(F.col(key), seed + 1), key)).alias("_r"))
    return a.join(b, ["_b", "_r"]).where(~F.col("other").eqNullSafe(F.col(answer))).drop("_b", "_r")
