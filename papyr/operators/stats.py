"""Aggregates and statistics of pools, grades, pairs and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyr.functions import normalise as N
from papyr.functions import signals as S
from papyr.functions.repair import Lexicon, split_words

# Classes from the rarest and most specific to the fallback.
CLAIM_ORDER = ["stem_reasoning", "how_to", "verse", "conversational", "reasoning", "narrative_grounded", "narrative_fiction", "opinion", "knowledge", "composition", "drop"]
# Rows wanted of each class.
QUOTAS = {"knowledge": 90000, "reasoning": 45000, "stem_reasoning": 24000, "narrative_grounded": 24000, "narrative_fiction": 24000, "opinion": 24000, "how_to": 24000, "conversational": 18000, "composition": 18000, "verse": 9000}
# The highest score a defect allows.
CAPS = {"question contains the answer proposition": 35, "unbalanced square brackets": 40, "unbalanced parentheses": 40, "unbalanced curly quotation marks": 49, "unbalanced straight quotation marks": 49, "dramatic speaker labels flattened into prose": 60, "probable OCR-split words": 55, "answer appears to end mid-sentence or mid-structure": 60}


def exact_percentiles(rows: DataFrame, group: list[str], value: str, points: dict[str, float], inclusive: bool = True) -> DataFrame:
    """Order statistics by group: the value at place ``int(q * (n - 1))`` of the sorted ones, or at ``min(int(n * q), n - 1)``.

    Equal values are counted first, so a group is held as its distinct values' counts, and the places are found by running sums.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*group).orderBy(value)
    c = counts.withColumns({"_upto": F.sum("_n").over(run), "_all": F.sum("_n").over(Window.partitionBy(*group))})
    place = lambda q: F.floor(F.lit(q) * (F.col("_all") - 1)) if inclusive else F.least(F.floor(F.col("_all") * q), F.col("_all") - 1)
    return c.groupBy(*group).agg(F.max("_all").alias("n"), *[F.min(F.when(F.col("_upto") > place(q), F.col(value))).alias(name) for name, q in points.items()])


def weighted_score(dims: dict[str, float], missing: int = 5) -> Column:
    """The weighted mean of columns; a missing one counts as 5."""
    return sum((F.coalesce(F.col(k), F.lit(missing)) * w for k, w in dims.items()), F.lit(0.0)) / sum(dims.values())


# Words without content, a reference to a figure, a speaker's label.
PLAIN_WORDS = "the a an and or of to in on for with that this who which what how when where was were is are be being his her their he she".split()
FIGURE_REFERENCE = r"(?iU)\b(?:as (?:shown|indicated) in (?:the )?|see |shown in )(?:fig(?:ure)?\.?|diagram)\s*\d*"
SPEAKER_LABEL = r"\b[A-Z][a-z]{1,12}\.\s+(?=[A-Z])"
# What each defect is called.
WARNINGS = {
    "square": "unbalanced square brackets", "round": "unbalanced parentheses", "curly": "unbalanced curly quotation marks", "straight": "unbalanced straight quotation marks", "drama": "dramatic speaker labels flattened into prose",
    "split": "probable OCR-split words: ", "figure": "depends on a missing figure or diagram", "end": "answer appears to end mid-sentence or mid-structure", "prefix": "meta prompt prefix: Comprehend",
    "summary": "question over-summarizes the narrative answer", "proposition": "the question contains the answer proposition",
}


def warnings(question: Column, answer: Column, route: Column, lexicon: Lexicon | None = None) -> Column:
    """The structural defects of a graded row, as an array of names; words torn apart are looked for where a lexicon is given."""
    q, a = F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit(""))
    text = F.when(a != "", a).otherwise(q)
    uneven = lambda x, y: S.count(text, x) != S.count(text, y)
    story = route.isin("narrative_grounded", "narrative_fiction")
    content = F.filter(N.word_tokens(q), lambda w: ~w.isin(PLAIN_WORDS))
    told = N.word_tokens(a)
    overlap = F.size(F.filter(content, lambda w: F.array_contains(told, w))) / F.greatest(F.size(content), F.lit(1))
    flat = lambda x: F.array_join(F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0)), " ")
    torn = F.lit(None).cast("string")
    if lexicon is not None:
        torn = F.nullif(lexicon.udf(lambda t, words: ", ".join(split_words(t, words)[:3]), "string")(text), F.lit(""))
    found = {
        "square": uneven(r"\[", r"\]"), "round": uneven(r"\(", r"\)"), "curly": uneven("“", "”"), "straight": S.count(text, '"') % 2 == 1,
        "drama": (route == "narrative_fiction") & ~F.contains(text, F.lit("\n")) & (S.count(text, SPEAKER_LABEL) >= 2),
        "split": torn.isNotNull(),
        "figure": route.isin("stem_reasoning", "how_to_qa") & S.has(F.concat(q, F.lit(" "), a), FIGURE_REFERENCE),
        "end": S.has(text, r"(?U)(?:[:;,]|---?)\s*\z"),
        "prefix": story & S.has(q, r"(?iU)\A\s*comprehend:"),
        "summary": story & (F.size(content) >= 35) & (overlap >= 0.6),
        "proposition": (route == "knowledge_qa") & (F.size(F.split(flat(a), " ")) >= 5) & F.contains(flat(q), flat(a)),
    }
    name = lambda k: F.concat(F.lit(WARNINGS[k]), torn) if k == "split" else F.lit(WARNINGS[k])
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), name(k)) for k, c in found.items()]), lambda x: x.isNotNull())


def warning_cap(names: Column) -> Column:
    """The highest score that defects allow; 100 without any, or with null."""
    def names_defect(k: str) -> Column:
        return F.exists(names, lambda w: F.contains(w, F.lit(k)))

    caps = F.array(F.lit(100), *[F.when(names_defect(k), F.lit(v)) for k, v in CAPS.items()])
    return F.coalesce(F.array_min(F.filter(caps, lambda x: x.isNotNull())), F.lit(100))


def grade_summary(rows: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    """n, mean and bands of scores by group; null scores don't count."""
    s = F.col(score)
    return rows.where(s.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.bround(F.avg(s), 3).alias("mean"), F.count_if(s >= 90).alias("b90"), F.count_if(s.between(75, 89)).alias("b75"), F.count_if(s.between(50, 74)).alias("b50"), F.count_if(s < 50).alias("below50"),
    )


def class_report(rows: DataFrame, classes: str = "classes") -> DataFrame:
    """(class, labelled, primary_n, quota, short): how often each class is given, how often it comes first, and what is wanting of its quota."""
    order = F.create_map(*[F.lit(x) for kv in QUOTAS.items() for x in kv])
    labelled = rows.select(F.explode(F.array_distinct(classes)).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("labelled"))
    first = F.coalesce(F.get(F.filter(F.array(*map(F.lit, CLAIM_ORDER)), lambda c: F.array_contains(F.coalesce(F.col(classes), F.array().cast("array<string>")), c)), F.lit(0)), F.lit("drop"))
    primary = rows.select(first.alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("primary_n"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return labelled.join(primary, "class", "full").select("class", z("labelled").alias("labelled"), z("primary_n").alias("primary_n"), F.coalesce(order[F.col("class")], F.lit(0)).cast("long").alias("quota"), F.greatest(F.coalesce(order[F.col("class")], F.lit(0)) - z("primary_n"), F.lit(0)).cast("long").alias("short"))


def question_metrics(q: Column, a: Column, other: Column) -> dict[str, Column]:
    """Echo, template, length, exact match and Jaccard overlap of a question with its answer and another question."""
    return {"echo": N.echo(q, a), "template": N.is_template(q), "length": F.length(q), "exact": F.lower(F.trim(q)) == F.lower(F.trim(other)), "jaccard": N.jaccard(q, other)}


def longest_shared_run(s: Column, a: Column) -> Column:
    """The longest run of words that a question shares with another one, over its own length; 0 without words.

    For each start the run grows while it stands in the other text, as a fold over starts and lengths.
    """
    words = N.word_tokens(s)
    hay = F.concat(F.lit(" "), F.array_join(N.word_tokens(a), " "), F.lit(" "))
    stands = lambda i, n: F.contains(hay, F.concat(F.lit(" "), F.array_join(F.slice(words, i + 1, n), " "), F.lit(" ")))
    lengths = lambda i: F.sequence(F.lit(1), F.size(words) - i)
    best = F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), F.lit(0), lambda acc, i: F.greatest(acc, F.size(F.filter(lengths(i), lambda n: stands(i, n)))))
    return F.when(F.size(words) > 0, best / F.size(words)).otherwise(F.lit(0.0))


def rank_auc(rows: DataFrame, score: str, label: str, order: str) -> DataFrame:
    """The chance that a row labelled 1 scores above one labelled 0, by ordinal ranks; ties fall in ``order``.

    Without a window over all rows: ranks within ranges of the score, shifted by the counts of the ranges below.
    """
    from papyr.session import materialise

    r = materialise(rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(score, label, order).repartitionByRange(F.col(score), F.col(order)).withColumn("_p", F.spark_partition_id()), "auc")
    sizes = {x["_p"]: x["n"] for x in r.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    below, run = [], 0
    for p in sorted(sizes):
        below.append((p, run))
        run += sizes[p]
    shift = F.broadcast(rows.sparkSession.createDataFrame(below, "_p int, _below long"))
    ranked = r.join(shift, "_p").withColumn("_rank", F.col("_below") + F.row_number().over(Window.partitionBy("_p").orderBy(score, order)))
    pos = F.count_if(F.col(label) == 1)
    n = F.count(F.lit(1))
    ranks = F.sum(F.when(F.col(label) == 1, F.col("_rank")).otherwise(0))
    return ranked.agg(((ranks - pos * (pos + 1) / 2) / (pos * (n - pos))).alias("auc"))


def char_trigrams(rows: DataFrame, text: str, k: int) -> DataFrame:
    """The ``k`` most frequent runs of three characters of lower-case text, blanks included."""
    grams = F.regexp_extract_all(F.lower(F.col(text)), F.lit("(?s)(?=(.{3}))"), F.lit(1))
    return rows.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "gram").limit(k)


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(x: Column, y: Column) -> Column:
    return F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def centroids(rows: DataFrame, group: str, vec: str) -> DataFrame:
    """(group, n, centroid) of vectors: means by dimension, put back in order."""
    means = rows.select(group, F.posexplode(vec).alias("d", "x")).groupBy(group, "d").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return means.groupBy(group).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda s: s["m"]).alias("centroid"))


def variance_shares(rows: DataFrame, group: str, vec: str) -> DataFrame:
    """(between, total, share): how much of the vectors' variance lies between the groups."""
    x = rows.select(group, F.posexplode(vec).alias("d", "x"))
    per = x.groupBy(group, "d").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("x").cast("double")).alias("m"), F.sum(F.col("x").cast("double") * F.col("x")).alias("ss"))
    d = per.groupBy("d").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mu"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("between"), F.sum("ss").alias("ss"))
    return d.agg(F.sum((F.col("between") - F.col("n") * F.col("mu") * F.col("mu")) / F.col("n")).alias("between"), F.sum((F.col("ss") - F.col("n") * F.col("mu") * F.col("mu")) / F.col("n")).alias("total")).withColumn("share", F.try_divide("between", "total"))
