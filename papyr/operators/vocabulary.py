"""Words out of a period: the vocabulary of a corpus, what a text has beyond it, and lists of barred words and phrases.

Vocabularies grow with the corpus, so texts meet them by shuffled joins on words, never by a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = "[A-Za-z][A-Za-z'-]*"  # fixed pattern


def words(c: Column) -> Column:
    """The words of a text as they stand, with apostrophes and hyphens; none for null."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def period_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) in lower case over all texts."""
    return texts.select(F.explode(words(F.col(text))).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def period_vocabulary(counts: DataFrame, least: int = 3) -> DataFrame:
    """(word) of those that stand ``least`` times or more: rarer ones are misreadings and names."""
    return counts.where(F.col("n") >= least).select("word")


def _plain(w: Column) -> Column:
    low = F.regexp_replace(F.lower(w), "'s$", "")
    return F.btrim(low, F.lit("'-"))


def out_of_period(rows: DataFrame, key: str, text: str, vocabulary: DataFrame, least: int = 3) -> DataFrame:
    """(key, words): the sorted distinct words of each text that the vocabulary lacks; texts without any have no row.

    Capitalised words after the first are names and pass, as do possessives of known words, words of fewer than
    ``least`` letters, and compounds whose parts are all known.
    """
    tokens = F.filter(words(F.col(text)), lambda w, i: (i == 0) | ~F.rlike(w, F.lit("^[A-Z]")))
    kept = rows.select(F.col(key).alias("_key"), F.explode(F.array_distinct(F.transform(tokens, _plain))).alias("word")).where(F.length("word") >= least)
    known = vocabulary.select("word").distinct()
    new = kept.select("word").distinct().join(known, "word", "left_anti")
    parts = new.select("word", F.explode(F.filter(F.split("word", "-"), lambda p: p != "")).alias("part"))
    held = parts.join(known.select(F.col("word").alias("part"), F.lit(1).alias("_k")), "part", "left")
    compounds = held.groupBy("word").agg(F.count(F.lit(1)).alias("_n"), F.count("_k").alias("_held")).where((F.col("_n") > 1) & (F.col("_held") == F.col("_n"))).select("word")
    unknown = new.join(compounds, "word", "left_anti")
    return kept.join(unknown, "word").groupBy(F.col("_key").alias(key)).agg(F.array_sort(F.collect_set("word")).alias("words"))


def barred_words(c: Column, barred: list[str]) -> Column:
    """The sorted distinct words of a text that are on a list."""
    return F.array_sort(F.array_intersect(F.transform(words(c), F.lower), F.array(*map(F.lit, barred)).cast("array<string>")))


def barred_phrases(c: Column, barred: list[str]) -> Column:
    """The phrases of a list that a text holds as whole words, in the list's order."""
    flat = F.concat(F.lit(" "), F.array_join(F.transform(words(c), F.lower), " "), F.lit(" "))
    return F.filter(F.array(*map(F.lit, barred)).cast("array<string>"), lambda p: F.contains(flat, F.concat(F.lit(" "), p, F.lit(" "))))


def scan(rows: DataFrame, key: str, text: str, barred: list[str], phrases: list[str], vocabulary: DataFrame | None = None) -> DataFrame:
    """(check, flagged, texts, pct): how many texts each check flags; words beyond the vocabulary are looked for where one is given."""
    c = F.col(text)
    some = lambda x: F.count_if(F.size(x) > 0)
    own = rows.agg(F.count(F.lit(1)).alias("texts"), some(barred_words(c, barred)).alias("words"), some(barred_phrases(c, phrases)).alias("phrases"))
    lines = own.select("texts", F.explode(F.array(F.struct(F.lit("words").alias("check"), F.col("words").alias("flagged")), F.struct(F.lit("phrases").alias("check"), F.col("phrases").alias("flagged")))).alias("l")).select("l.check", "l.flagged", "texts")
    if vocabulary is not None:
        beyond = out_of_period(rows, key, text, vocabulary).agg(F.count(F.lit(1)).alias("flagged"))
        lines = lines.unionByName(own.crossJoin(beyond).select(F.lit("out_of_period").alias("check"), "flagged", "texts"))  # one row each
    return lines.withColumn("pct", F.bround(F.coalesce(100 * F.try_divide("flagged", "texts"), F.lit(0.0)), 2))
