"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyr.llm import bpe
from papyr.session import materialise

BUCKETS = 4096  # steps of the seeded order in which a source's fraction is drawn


@dataclass(frozen=True)
class Share:
    source: str
    target: float  # of the weights' sum
    size: int  # one epoch
    cap: int  # most repetitions
    allotted: float = 0.0


def water_fill(shares: list[Share], budget: float) -> list[Share]:
    """Allot ``budget`` in proportion to the targets, none above size times cap.

    A source whose share would exceed its cap is clamped there and the rest is shared out again in
    proportion, until no share exceeds its cap (or all are clamped, and the budget isn't reached).
    """
    free = {s.source: s for s in shares if s.target > 0 and s.size > 0 and s.cap > 0}
    given = {s.source: 0.0 for s in shares}
    left = float(budget)
    while free and left > 1e-9:
        weight = sum(s.target for s in free.values())
        over = [s for s in free.values() if left * s.target / weight >= s.size * s.cap - 1e-9]
        if not over:
            for s in free.values():
                given[s.source] = left * s.target / weight
            break
        for s in over:
            given[s.source] = float(s.size * s.cap)
            del free[s.source]
        left = float(budget) - sum(given[s.source] for s in shares if s.source not in free)
    return [Share(s.source, s.target, s.size, s.cap, given[s.source]) for s in shares]


def _place(key: Column, source: Column, seed: int) -> Column:
    """The seeded place of a record in its source's order: a bucket, then a hash."""
    return F.xxhash64(F.lit(seed), source, key)


def mix(sizes: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 0, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(mixture, report) of records ``sizes`` (key, source, n_tokens) and ``targets`` (source, target_pct, max_repeats).

    The mixture has one row per use of a record: key, source, copy (from 1), n_tokens. Every record of a
    source is used floor(e) times, e being the source's epochs, and the records first in a seeded
    order once more, until the source's allotment is met as nearly as whole records allow, and
    never beyond the cap. The report has a row per source of ``targets`` with target and actual shares.
    ``budget`` is the size to reach in all, by default one epoch of all the listed sources.

    Records with null source, or of a source that has no target, and records of size 0 or null are
    not used. A null target or cap counts as 0; of a source listed twice the weights add up and the
    greatest cap holds. A source without records has allotment and share 0, and its weight goes to
    the others. ``targets`` is a bounded table. Repeated keys count as records of their own.

    Only sums per source and bucket of the seeded order (BUCKETS a source) come to the driver, and a window
    orders just the records of each source's one bucket in which the drawing ends.
    """
    spark = sizes.sparkSession
    listed = {
        r["source"]: (float(r["w"] or 0), int(r["c"] or 0))
        for r in targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum(F.greatest(F.col("target_pct"), F.lit(0))).alias("w"), F.max(F.greatest(F.col("max_repeats"), F.lit(0))).alias("c")).collect()
    }
    names = sorted(listed)
    usable = sizes.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)).select(key, "source", F.col("n_tokens").cast("bigint").alias("n_tokens"), _place(F.col(key), F.col("source"), seed).alias("_h"))
    bucket = F.pmod(F.col("_h"), F.lit(BUCKETS)).cast("int")
    usable = usable.withColumn("_b", bucket)
    sums: dict[str, dict[int, int]] = {s: {} for s in names}
    for r in usable.groupBy("source", "_b").agg(F.sum("n_tokens").alias("n")).collect():
        sums[r["source"]][r["_b"]] = int(r["n"])
    totals = {s: sum(v.values()) for s, v in sums.items()}
    weight = sum(w for w, _ in listed.values()) or 1.0
    shares = [Share(s, listed[s][0] / weight, totals[s], listed[s][1]) for s in names]
    want = budget if budget is not None else sum(s.size for s in shares if s.target > 0)
    plan = []
    for s in water_fill(shares, want):
        whole = int(s.allotted // s.size) if s.size else 0
        rest = s.allotted - whole * s.size if s.size else 0.0
        if whole >= s.cap:
            whole, rest = s.cap, 0.0
        upto, last = -1, 0.0  # buckets up to `upto` are drawn wholly, `last` tokens of the next one
        if rest > 0:
            run = 0
            for b in range(BUCKETS):
                n = sums[s.source].get(b, 0)
                if run + n > rest:
                    last = rest - run
                    break
                run, upto = run + n, b
        plan.append((s.source, whole, upto, float(last), s.target, s.cap, s.size, s.allotted))
    schema = "source string, whole int, upto int, last double, target double, cap int, size bigint, allotted double"
    plan_df = F.broadcast(spark.createDataFrame(plan, schema))
    joined = usable.join(plan_df.select("source", "whole", "upto", "last"), "source")
    edge = F.col("_b") == F.col("upto") + 1
    # a record of the last bucket is drawn if more than half of it fits into what is left
    at = Window.partitionBy("source").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)
    in_edge = joined.where(edge & (F.col("last") > 0)).withColumn("_before", F.coalesce(F.sum("n_tokens").over(at), F.lit(0)))
    in_edge = in_edge.withColumn("_uses", F.col("whole") + F.when(F.col("_before") + F.col("n_tokens") / 2 <= F.col("last"), 1).otherwise(0)).drop("_before")
    rest_of = joined.where(~(edge & (F.col("last") > 0))).withColumn("_uses", F.col("whole") + F.when(F.col("_b") <= F.col("upto"), 1).otherwise(0))
    uses = rest_of.unionByName(in_edge).where(F.col("_uses") > 0)
    mixture = uses.select(key, "source", F.explode(F.sequence(F.lit(1), F.col("_uses"))).alias("copy"), "n_tokens")
    real = uses.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("_uses")).alias("_actual"), F.count(F.lit(1)).alias("documents_used"), F.max("_uses").alias("most_copies"), F.sum("_uses").alias("rows"))
    every = Window.partitionBy(F.lit(1))
    report = (
        plan_df.join(real, "source", "left")
        .withColumn("actual_tokens", F.coalesce("_actual", F.lit(0)))
        .select(
            "source",
            F.bround(F.col("target") * 100, 4).alias("target_pct"),
            F.col("cap").alias("max_repeats"),
            F.col("size").alias("source_tokens"),
            F.bround("allotted", 3).alias("allotted_tokens"),
            "actual_tokens",
            F.bround(100 * F.try_divide(F.col("actual_tokens"), F.sum("actual_tokens").over(every)), 4).alias("actual_pct"),
            F.coalesce("documents_used", F.lit(0)).alias("documents_used"),
            F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
            (F.col("allotted") >= F.col("size") * F.col("cap")).alias("capped"),
        )
    )
    return mixture, report


def token_sizes(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of each document, written once so that the passes over sizes don't tokenise again."""
    return materialise(bpe.count_column(documents, "text", ["doc_id", "source"], path), "sizes")
