"""The queries over the problems' tables. Each takes the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyr.llm import bpe, cutoff, defects, encoding, language, mixing, quality, scan, subjects
from papyr.session import spread
from papyr.session import table as stored


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the folder; texts are read by all cores, however few the files."""
    df = stored(spark, base, name)
    return spread(df) if name in ("documents", "excerpts", "pairs", "conversations_nested") else df


def rec_id(*names: str) -> Column:
    """The record's name: its key, or dataset and number joined by two hyphens."""
    return F.concat_ws("--", *[F.col(n).cast("string") for n in names])


def _restored(spark: SparkSession, base: str) -> DataFrame:
    """(src, rec_id, restored, chains, lost, damaged) of all documents and answers."""
    docs, pairs = table(spark, base, "documents"), table(spark, base, "pairs")
    texts = docs.select(F.lit("documents").alias("src"), rec_id("doc_id").alias("rec_id"), encoding.language_column(F.col("lang")).alias("lang"), "text")
    answers = pairs.select(F.lit("pairs").alias("src"), rec_id("dataset", "i").alias("rec_id"), F.lit("other").alias("lang"), F.col("a").alias("text"))
    every = texts.unionByName(answers)
    return encoding.repair_column(every, ["src", "rec_id"], "text", encoding.learn(every))


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return _restored(spark, base).where("damaged").select("src", "rec_id").distinct()


def p1_restored(spark: SparkSession, base: str) -> DataFrame:
    """Each delivered record with the text as it was, the chains undone, and the characters that stay lost."""
    return _restored(spark, base).select("src", "rec_id", F.col("restored").alias("text"), F.array_join("chains", " ; ").alias("chains"), "lost")


def _measured(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, base, "documents").select(F.lit("documents").alias("src"), rec_id("doc_id").alias("rec_id"), "text", F.lit(None).cast("double").alias("prose_score"))
    excerpts = table(spark, base, "excerpts").select(F.lit("excerpts").alias("src"), F.col("doc_index").alias("rec_id"), F.col("excerpt").alias("text"), F.col("prose_score").cast("double").alias("prose_score"))
    return quality.analyse(docs.unionByName(excerpts), ["src", "rec_id", "prose_score"])


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return _measured(spark, base)[0].where(~F.col("is_prose")).select("src", "rec_id").distinct()


def p2_statistics(spark: SparkSession, base: str) -> DataFrame:
    """The statistics, z-scores and percentiles of every delivered record, and whether a prose score that came with it fits them."""
    return quality.judge_given(_measured(spark, base)[0], "prose_score")


def p2_distributions(spark: SparkSession, base: str) -> DataFrame:
    """Quantiles of each statistic by language, from the merged sketches."""
    rows = [(g["lang"], g["texts"], s, q, float(v)) for g in quality.quantiles(_measured(spark, base)[1]) for s in quality.STATISTICS for q, v in zip(quality.GRID, g[s], strict=True)]
    return spark.createDataFrame(rows, "lang string, texts bigint, statistic string, quantile double, value double")


def _subjects(spark: SparkSession, base: str) -> DataFrame:
    return subjects.subjects(table(spark, base, "documents"), table(spark, base, "subject_examples"))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return _subjects(spark, base).select("doc_id", "subject").distinct()


def p3_scores(spark: SparkSession, base: str) -> DataFrame:
    """Each document's subjects with cosines and parts."""
    return _subjects(spark, base)


def p3_composition(spark: SparkSession, base: str) -> DataFrame:
    """The share of each subject in the corpus."""
    return subjects.composition(_subjects(spark, base))


def p3_labels(spark: SparkSession, base: str) -> DataFrame:
    """The catalogue's labels beside the subjects found: right, wrong, missing or unknown."""
    return subjects.compare_labels(_subjects(spark, base), table(spark, base, "doc_meta"))


def _repaired(spark: SparkSession, base: str) -> DataFrame:
    docs, pairs = table(spark, base, "documents"), table(spark, base, "pairs")
    texts = docs.select("text").unionByName(pairs.select(F.explode(F.array("q", "a")).alias("text"))).where(F.col("text").isNotNull())
    words = scan.learn(texts, table(spark, base, "lexicon"))
    names = docs.select(F.lit("documents").alias("src"), rec_id("doc_id").alias("rec_id"), "text")
    of_docs = scan.repair_columns(names, ["src", "rec_id"], ["text"], words)
    of_pairs = scan.repair_columns(pairs.select(F.lit("pairs").alias("src"), rec_id("dataset", "i").alias("rec_id"), "q", "a"), ["src", "rec_id"], ["q", "a"], words)
    return of_docs.unionByName(of_pairs)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return _repaired(spark, base).where(F.col("furniture") + F.col("breaks") + F.col("misread") > 0).select("src", "rec_id").distinct()


def p4_repaired(spark: SparkSession, base: str) -> DataFrame:
    """Every text in continuous paragraphs, with the number of repairs of each kind."""
    return _repaired(spark, base)


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return cutoff.graded_cutoffs(table(spark, base, "graded_rows"), table(spark, base, "keep_targets"))


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    records = defects.turns_of_pairs(table(spark, base, "pairs")).unionByName(defects.turns_of_conversations(table(spark, base, "conversations_nested")))
    return defects.find(records, defects.learn(records)).distinct()


def p7_ids(spark: SparkSession, base: str) -> DataFrame:
    return bpe.encode_column(table(spark, base, "documents"), "doc_id", "text")


def p8_mixture(spark: SparkSession, base: str) -> DataFrame:
    sizes = mixing.token_sizes(table(spark, base, "documents"))
    return mixing.mix(sizes, table(spark, base, "mix_targets"))[0]


def p8_report(spark: SparkSession, base: str) -> DataFrame:
    sizes = mixing.token_sizes(table(spark, base, "documents"))
    return mixing.mix(sizes, table(spark, base, "mix_targets"))[1]


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return language.languages(docs, language.learn(docs)).where("cased").select("doc_id", "lang")


def p9_languages(spark: SparkSession, base: str) -> DataFrame:
    """Every language of every document with its confidence, beside what the document's own label names."""
    docs = table(spark, base, "documents")
    return language.languages(docs, language.learn(docs)).select("doc_id", "label", "lang", "confidence")


def p9_segments(spark: SparkSession, base: str) -> DataFrame:
    """The stretches of each document in one language, with their places and confidences."""
    docs = table(spark, base, "documents")
    return language.segments(docs, language.learn(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_restored": p1_restored,
    "p2_found": p2_found,
    "p2_statistics": p2_statistics,
    "p2_distributions": p2_distributions,
    "p3_found": p3_found,
    "p3_scores": p3_scores,
    "p3_composition": p3_composition,
    "p3_labels": p3_labels,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_mixture": p8_mixture,
    "p8_report": p8_report,
    "p9_found": p9_found,
    "p9_languages": p9_languages,
    "p9_segments": p9_segments,
}

SQL = {
    "p5_found": """
        WITH last AS (
            SELECT row_id, max(struct_pack(at := ingested_at, c := category, s := score)) AS v
            FROM graded_rows WHERE row_id IS NOT NULL GROUP BY row_id
        ), scored AS (
            SELECT replace(lower(regexp_replace(v.c, '^[\\s ]+|[\\s ]+$', '', 'g')), '-', '_') AS k, v.s AS s FROM last WHERE v.s BETWEEN 0 AND 100
        ), ranked AS (
            SELECT t.category, t.target_pct, s, row_number() OVER (PARTITION BY t.category ORDER BY s DESC) AS r, count(*) OVER (PARTITION BY t.category) AS n
            FROM scored JOIN keep_targets t ON k = replace(lower(regexp_replace(t.category, '^[\\s ]+|[\\s ]+$', '', 'g')), '-', '_') WHERE k <> ''
        ), cut AS (
            SELECT category, CAST(max(s) AS INTEGER) AS cutoff FROM ranked WHERE r >= target_pct * n / 100.0 GROUP BY category
        )
        SELECT c.category, c.cutoff, count(*) AS kept FROM cut c JOIN ranked r ON r.category = c.category AND r.s >= c.cutoff GROUP BY ALL
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
