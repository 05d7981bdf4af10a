"""Passes put together: what is asked, what a reply must hold, and the rows that come out. Replies come from a provider, recorded or by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyr.operators.sampling import two_slices
from papyr.operators.stats import CLAIM_ORDER
from papyr.passes import verdicts
from papyr.passes.provider import Provider

DIMENSIONS = ("ocr", "intelligible", "relevant", "complete", "clean")  # fixed values: what a conversation is scored on
MIDDLE = 5  # fixed value: the score of a conversation that nobody could judge


def classify(excerpts: DataFrame, key: str, provider: Provider, budget: int = 2000, text: str = "excerpt") -> DataFrame:
    """(key, classes): the labels of each excerpt, those of the taxonomy only, in the order given; excerpts whose reply holds none stay unclassified."""
    asked = verdicts.requests(excerpts.withColumn("_one", F.lit(0)), key, F.col(text), "_one", key, budget)
    got = verdicts.by_index(asked, provider.replies(asked), "classes:array<string>")
    named = F.filter(F.coalesce(F.col("r.classes"), F.array().cast("array<string>")), lambda c: c.isin(CLAIM_ORDER))
    return got.select("key", named.alias("classes")).where(F.size("classes") > 0)


def stalled(checkpoints: DataFrame, most: int = 8) -> DataFrame:
    """(pass): the passes whose stored count didn't grow over the last ``most`` checkpoints (pass, n, stored), in a row: asking on is of no use."""
    last = checkpoints.groupBy("pass").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "stored")), asc=False), F.lit(1), F.lit(most + 1)).alias("_c"))  # one row a checkpoint
    return last.where((F.size("_c") == most + 1) & (F.get("_c", F.lit(0))["stored"] == F.get("_c", F.lit(most))["stored"])).select("pass")


def scored(conversations: DataFrame, key: str, provider: Provider, prompt: Column, budget: int = 2000) -> DataFrame:
    """(key, ocr, intelligible, relevant, complete, clean): the marks of each conversation; one a reply leaves out is null, and all are MIDDLE where the batch has no readable reply."""
    asked = verdicts.requests(conversations.withColumn("_one", F.lit(0)), key, prompt, "_one", key, budget)
    replies = provider.replies(asked)
    got = verdicts.by_index(asked, replies, ", ".join(f"{d}:int" for d in DIMENSIONS)).select("key", *[F.col(f"r.{d}").alias(d) for d in DIMENSIONS])
    readable = replies.where(F.from_json(verdicts.N.reply_array(F.col("body")), "array<struct<i:int>>").isNotNull()).select("batch_id").distinct()
    silent = asked.join(readable, "batch_id", "left_anti").select("key", *[F.lit(MIDDLE).alias(d) for d in DIMENSIONS])
    return got.unionByName(silent)


def enriched(pairs: DataFrame, detect: Provider, rewrite: Provider, budget: int = 2000) -> DataFrame:
    """``pairs`` (dataset, i, q, a) with ``status``, ``q`` as rewritten where it was ambiguous, and ``enriched``.

    A question without a readable status is clear. Ambiguous ones are asked for again, dataset by dataset, and stay as
    they are where the reply is blank. Bare ones are attached to the row before by :func:`papyr.operators.sequence.attach`.
    """
    rows = pairs.withColumn("_key", F.concat_ws("--", "dataset", F.col("i").cast("string")))
    asked = verdicts.requests(rows, "_key", F.col("q"), "dataset", "i", budget)
    status = verdicts.by_index(asked, detect.replies(asked), "status:string").select(F.col("key").alias("_k"), F.col("r.status").alias("status"))
    known = rows.join(status, F.col("_key") == F.col("_k"), "left").drop("_k").withColumn("status", F.coalesce("status", F.lit("clear")))
    again = verdicts.requests(known.where("status = 'ambiguous'"), "_key", F.concat_ws("\n", "q", "a"), "dataset", "i", budget)
    new = verdicts.by_index(again, rewrite.replies(again), "q:string").select(F.col("key").alias("_k"), F.nullif(F.trim("r.q"), F.lit("")).alias("_new"))
    out = known.join(new, F.col("_key") == F.col("_k"), "left")
    return out.withColumns({"enriched": F.col("_new").isNotNull(), "q": F.coalesce("_new", "q")}).drop("_key", "_k", "_new")


def bleed_retry(pairs: DataFrame, left: DataFrame) -> DataFrame:
    """The pairs to be asked about again: those whose answer, or half question, still seems to hold a numbered question, and whose parts weren't split before. ``left`` (dataset, i) are keys that came through a split."""
    from papyr.functions import signals as S

    again = pairs.where(F.coalesce(S.is_bleed_candidate(F.col("q"), F.col("a")), F.lit(False)))
    done = left.select(F.col("dataset").alias("_d"), F.col("i").alias("_i")).distinct()
    return again.join(done, F.col("dataset").eqNullSafe(F.col("_d")) & (F.col("i") == F.col("_i")), "left_anti")


def pool(excerpts: DataFrame, route: verdicts.Route, key: str = "doc_index", floor: float = 0.7, seed: int = 0) -> DataFrame:
    """The excerpts a route draws on: those it may use, of which routes that share a class take overlapping slices of one seeded order."""
    own = verdicts.sources(excerpts, route, floor)
    if not route.pool:
        return own
    cut = two_slices(own, key, seed=seed)
    return cut.where("in_first" if route.pool == "first" else "in_second").drop("in_first", "in_second")


def run_route(excerpts: DataFrame, route: verdicts.Route, provider: Provider, questions: Provider | None = None, key: str = "doc_index", budget: int = 1200) -> DataFrame:
    """(doc_index, category, book_category, year, question, answer) of a route, from the request to the row.

    One phase: each reply has question and spans. Two phases: the first has spans alone; answers that pass the check are asked a
    question in a second request of half the budget. Rows whose answer fails the check or that lack a side fall out.
    """
    spans = "array<struct<verbatim:string,refurbished:string>>" if route.answer == "refurbished" else "array<string>"
    rows = excerpts.withColumn("_one", F.lit(0))
    asked = verdicts.requests(rows, key, F.col("excerpt"), "_one", key, budget)
    got = verdicts.by_index(asked, provider.replies(asked), f"q:string,category:string,spans:{spans}").select(F.col("key").alias("_k"), F.col("r.q").alias("question"), F.col("r.category").alias("model_category"), F.col("r.spans").alias("_spans"))
    answered = rows.join(got, F.col(key).cast("string") == F.col("_k")).withColumn("answer", verdicts.checked_answer(route, F.col("_spans"), F.col("excerpt"))).where(F.col("answer").isNotNull()).drop("_k", "_spans")
    if route.phases == 2:
        if questions is None:
            raise ValueError(f"{route.name} has two phases and needs a provider of questions")
        second = verdicts.requests(answered, key, F.concat_ws("\n", "excerpt", "answer"), "_one", key, max(1, budget // 2))
        q = verdicts.by_index(second, questions.replies(second), "q:string").select(F.col("key").alias("_k"), F.col("r.q").alias("_q"))
        answered = answered.join(q, F.col(key).cast("string") == F.col("_k")).withColumn("question", F.col("_q")).drop("_k", "_q")
    return verdicts.output_rows(answered)
