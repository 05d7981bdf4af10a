"""Score cutoffs that keep a target fraction of each source's records.

The order statistic is found as the minimiser of the source's pinball loss, a convex piecewise
linear function of the cutoff. Each round evaluates loss and subgradient of every source at one
point in a single aggregation; the two supporting lines of the bracket cross at the next point
(Kelley's cutting plane). When the subgradients at the bracket's ends show that no breakpoint but
one is left, the cutoff snaps to that score, which is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60  # each round drops a breakpoint at least from a bracket; ranks halve it when the loss is flat


def category_key(c: Column) -> Column:
    """A category without regard to case, outer blanks and hyphen against underscore; blank is null."""
    key = F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), "-", "_")
    return F.when(key != "", key)


def latest_rows(rows: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """The row of each ``key`` with the latest ``at``. Ties of ``at`` fall to the greatest values, nulls of ``at`` come first.

    A hash aggregation with partial results, so a key that was delivered often is combined before the shuffle.
    """
    packed = F.struct(F.col(at).alias("_at"), *[F.col(v).alias(v) for v in values])
    last = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(packed).alias("_last"))
    return last.select(key, *[F.col(f"_last.{v}").alias(v) for v in values])


def score_counts(records: DataFrame, source: str, score: str) -> DataFrame:
    """(source, score, n): equal scores of a source are one row, however many records a source holds."""
    scored = records.where(F.col(source).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return scored.groupBy(F.col(source).alias("source"), F.col(score).cast("double").alias("score")).agg(F.count(F.lit(1)).alias("n"))


def order_statistics(counts: DataFrame, keep: dict[str, float]) -> dict[str, tuple[float, int, int]]:
    """For each source the greatest observed score t with ``count(score >= t) >= ceil(keep * N)``, that count, and N.

    ``counts`` are (source, score, n) rows; ``keep`` maps a source to its fraction in (0, 1]. Only
    a few numbers per source of ``keep`` (a table of targets, so bounded) reach the driver.
    Sources without scores are absent from the result.
    """
    names = list(keep)
    counts = counts.where(F.col("source").isin(names))
    first = counts.groupBy("source").agg(F.sum("n").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"), F.sum(F.col("n") * F.col("score")).alias("total"))
    state: dict[str, dict] = {}
    for r in first.collect():
        need = -(-int(round(keep[r["source"]] * 1_000_000)) * r["n"] // 1_000_000)
        need = min(max(need, 1), r["n"])
        state[r["source"]] = {"n": r["n"], "need": need, "lo": r["lo"], "hi": r["hi"], "total": r["total"]}
    done: dict[str, tuple[float, int, int]] = {}
    for s, x in state.items():
        # supporting lines at the ends: loss(t) = sum of tau*(score-t)+ and (1-tau)*(t-score)+, tau = share below
        n, need = x["n"], x["need"]
        tau = (n - need + 0.5) / n
        x |= {"tau": tau, "g_lo": -tau * n, "f_lo": tau * (x["total"] - n * x["lo"]), "g_hi": (1 - tau) * n, "f_hi": (1 - tau) * (n * x["hi"] - x["total"]), "halve": False}
    for round_ in range(MAX_ROUNDS * 40):
        open_ = {s: x for s, x in state.items() if s not in done}
        if not open_:
            return done
        points = {}
        for s, x in open_.items():
            lo, hi = x["lo"], x["hi"]
            cross = (x["f_lo"] - x["f_hi"] + x["g_hi"] * hi - x["g_lo"] * lo) / (x["g_hi"] - x["g_lo"]) if x["g_hi"] > x["g_lo"] else lo
            points[s] = (lo + hi) / 2 if x["halve"] or not lo <= cross <= hi else cross
        at = F.create_map(*[F.lit(v) for kv in points.items() for v in kv])[F.col("source")]
        above, below, equal = F.col("score") > F.col("t"), F.col("score") < F.col("t"), F.col("score") == F.col("t")
        zero = F.lit(0)
        got = (
            counts.where(F.col("source").isin(list(points)))
            .withColumn("t", at)
            .groupBy("source", "t")
            .agg(
                F.sum(F.when(above, F.col("n")).otherwise(zero)).alias("n_above"),
                F.sum(F.when(equal, F.col("n")).otherwise(zero)).alias("n_equal"),
                F.sum(F.when(above, F.col("n") * (F.col("score") - F.col("t"))).otherwise(F.lit(0.0))).alias("over"),
                F.sum(F.when(below, F.col("n") * (F.col("t") - F.col("score"))).otherwise(F.lit(0.0))).alias("under"),
                F.max(F.when(~above, F.col("score"))).alias("at_or_below"),
                F.min(F.when(above, F.col("score"))).alias("next_above"),
                F.max(F.when(below, F.col("score"))).alias("next_below"),
            )
            .collect()
        )
        for r in got:
            s, x = r["source"], state[r["source"]]
            need, n, tau = x["need"], x["n"], x["tau"]
            n_ge = r["n_above"] + r["n_equal"]
            if r["n_equal"] and r["n_above"] < need <= n_ge:
                done[s] = (r["t"], n_ge, n)  # t itself is the order statistic
                continue
            loss = tau * r["over"] + (1 - tau) * r["under"]
            width = x["hi"] - x["lo"]
            if r["n_above"] >= need:  # the minimiser lies above; snap the left end to the next score
                x["lo"], x["g_lo"] = r["next_above"], (1 - tau) * (n - r["n_above"]) - tau * r["n_above"]
                x["f_lo"] = loss + x["g_lo"] * (r["next_above"] - r["t"])
            else:  # n_ge < need: it lies below; snap the right end to the score before
                x["hi"], x["g_hi"] = r["next_below"], (1 - tau) * (n - n_ge) - tau * n_ge
                x["f_hi"] = loss + x["g_hi"] * (r["next_below"] - r["t"])
            x["halve"] = not x["halve"] and x["hi"] - x["lo"] > width / 2
    raise RuntimeError("the cutting plane did not converge")


def keep_fraction(records: DataFrame, targets: DataFrame, source: str = "category", score: str = "score", percent: str = "target_pct") -> DataFrame:
    """Per source of ``targets``: the cutoff that keeps ``percent`` of its scored records, and the kept size.

    ``records`` hold one row per record. The result is (source, cutoff int, kept bigint, scored bigint):
    cutoff is the highest integer such that the records with score >= cutoff are at least ``percent``
    of the source's scored records. Null and NaN scores and null sources are left out; ties at the cutoff are
    all kept; a percent of 0 or below keeps nothing (cutoff is one above the highest score), one above
    100 counts as 100; a source without scored records, or a null percent, has no row. ``targets`` is
    a bounded table with one row per source (of repeated rows the greatest percent holds).
    """
    spark = records.sparkSession
    wanted = {r["s"]: float(r["p"]) for r in targets.where(F.col(source).isNotNull() & F.col(percent).isNotNull()).groupBy(F.col(source).alias("s")).agg(F.max(percent).alias("p")).collect()}
    schema = "source string, cutoff int, kept bigint, scored bigint"
    if not wanted:
        return spark.createDataFrame([], schema)
    counts = score_counts(records, source, score).cache()
    try:
        found = order_statistics(counts, {s: min(max(p, 0.0001), 100.0) / 100 for s, p in wanted.items()})
        rows = []
        for s, (t, kept, n) in sorted(found.items()):
            if wanted[s] <= 0:
                rows.append((s, None, 0, n))
            else:
                rows.append((s, int(t // 1), kept, n))
        zero = [s for s, c, _, _ in rows if c is None]
        if zero:
            tops = {r["source"]: r["m"] for r in counts.where(F.col("source").isin(zero)).groupBy("source").agg(F.max("score").alias("m")).collect()}
            rows = [(s, int(tops[s] // 1) + 1 if c is None else c, k, n) for s, c, k, n in rows]
        # the cutoff is a whole number, so scores between it and the order statistic are kept as well
        cut = F.create_map(*[F.lit(v) for s, c, _, _ in rows for v in (s, c)])[F.col("source")] if rows else None
        if rows:
            kept = {r["source"]: r["k"] for r in counts.where(F.col("source").isin([r[0] for r in rows]) & (F.col("score") >= cut)).groupBy("source").agg(F.sum("n").alias("k")).collect()}
            rows = [(s, c, int(kept.get(s, 0)), int(n)) for s, c, _, n in rows]
    finally:
        counts.unpersist()
    return spark.createDataFrame(rows, schema)


def graded_cutoffs(graded: DataFrame, targets: DataFrame) -> DataFrame:
    """(category, cutoff, kept): :func:`keep_fraction` over the latest delivery of each graded row with a score from 0 to 100."""
    latest = latest_rows(graded, "row_id", "ingested_at", ["category", "score"])
    valid = latest.where(F.col("score").between(0, 100)).select(category_key(F.col("category")).alias("category"), "score")
    names = targets.select(F.col("category").alias("name"), category_key(F.col("category")).alias("category"), "target_pct")
    found = keep_fraction(valid, names)
    return F.broadcast(found).join(names, found["source"] == names["category"]).select(F.col("name").alias("category"), "cutoff", "kept")
