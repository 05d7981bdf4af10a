"""Queries of vocabularies, reports and assembled routes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyr.operators import reports, vocabulary
from papyr.passes import assembly, verdicts
from papyr.plans import signal_sql
from papyr.plans.pool_queries import _P
from papyr.plans.pool_queries import _pairs as latest_pairs
from papyr.session import spread, table

BARRED = ["engine", "electron", "telephone", "isotope", "radio", "orchestra"]
PHRASES = ["of the", "at all", "in the same", "news of it"]


def period_words(spark, base):
    """Words of questions that answers don't know, as one line a question."""
    p = latest_pairs(spark, base)
    vocab = vocabulary.period_vocabulary(vocabulary.period_counts(p, "a"))
    keyed = p.select(F.concat_ws("--", "dataset", F.col("i").cast("string")).alias("key"), "q")
    return vocabulary.out_of_period(keyed, "key", "q", vocab).select("key", F.array_join("words", " ").alias("words"))


def barred(spark, base):
    d = spread(table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", "text"))
    hits = d.select("doc_id", F.array_join(vocabulary.barred_words(F.col("text"), BARRED), " ").alias("words"), F.array_join(vocabulary.barred_phrases(F.col("text"), PHRASES), "|").alias("phrases"))
    return hits.where((F.col("words") != "") | (F.col("phrases") != ""))


def period_scan(spark, base):
    p = latest_pairs(spark, base).select(F.concat_ws("--", "dataset", F.col("i").cast("string")).alias("key"), "q", "a")
    return vocabulary.scan(p, "key", "q", BARRED, PHRASES, vocabulary.period_vocabulary(vocabulary.period_counts(p, "a")))


def category_profile(spark, base):
    return reports.category_profile(table(spark, base, "doc_meta"), "topic_or_subject_gen", "topic_or_subject_score_gen", "year", "word_count")


def relabelled(spark, base):
    return reports.relabel_delta(reports.relabel(spread(table(spark, base, "excerpts").select("excerpt", "affordance"))))


def grade_analysis(spark, base):
    return reports.grade_analysis(table(spark, base, "graded_rows"), "route")


def warning_histogram(spark, base):
    return reports.warning_histogram(table(spark, base, "graded_rows"), "route")


def judged(spark, base):
    """Graded rows as a judge's marks: the tens of the score, halved, and the length of the answer."""
    g = table(spark, base, "graded_rows").select("route", F.floor(F.col("score") / 20).cast("int").alias("answered"), F.least(F.floor(F.length("answer") / 40), F.lit(5)).cast("int").alias("period"))
    return reports.judge_summary(g, "route")


def retried(spark, base):
    """Documents as answers that would be asked about again, those split before left out."""
    d = table(spark, base, "documents").where(F.col("text").isNotNull()).select(F.coalesce("source", F.lit("-")).alias("dataset"), F.col("doc_id").alias("i"), F.lit("").alias("q"), F.col("text").alias("a"))
    return assembly.bleed_retry(d, d.where(F.col("i") % 7 == 0)).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def route_pools(spark, base):
    """The excerpts that routes draw on, those that share a class by slices of one order."""
    e = table(spark, base, "excerpts").where(F.col("excerpt").isNotNull()).select("doc_index", "classes", "prose_score", "excerpt", "affordance").dropDuplicates(["doc_index"])
    own = [assembly.pool(e, verdicts.ROUTES[n]).select(F.lit(n).alias("route"), "doc_index") for n in ("knowledge_qa", "multiturn_qa")]
    return own[0].unionByName(own[1]).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "period_words": period_words, "barred_words": barred, "period_scan": period_scan, "category_profile": category_profile, "relabel_delta": relabelled, "grade_analysis": grade_analysis, "warning_histogram": warning_histogram,
    "judge_summary": judged, "bleed_retry": retried, "route_pools": route_pools,
}

_BEYOND = f"""{_P}, v AS (SELECT word FROM (SELECT unnest(regexp_extract_all(a, '[A-Za-z][A-Za-z''-]*')) AS w, lower(w) AS word FROM p) GROUP BY word HAVING count(*) >= 3),
    t AS (SELECT concat_ws('--', dataset, i) AS key, regexp_extract_all(q, '[A-Za-z][A-Za-z''-]*') AS ws FROM p),
    k AS (SELECT DISTINCT key, trim(regexp_replace(lower(ws[j]), '''s$', ''), '''-') AS word FROM t, unnest(range(1, len(ws) + 1)) AS u(j) WHERE j = 1 OR NOT regexp_matches(ws[j], '^[A-Z]')),
    n AS (SELECT DISTINCT word FROM k WHERE length(word) >= 3 AND word NOT IN (SELECT word FROM v)), c AS (SELECT word, [x for x in string_split(word, '-') if x <> ''] AS parts FROM n),
    h AS (SELECT word FROM (SELECT word, unnest(parts) AS part, len(parts) AS m FROM c) LEFT JOIN (SELECT word AS vw FROM v) ON part = vw GROUP BY word, m HAVING m > 1 AND count(vw) = m),
    b AS (SELECT key, array_to_string(list_sort(list(DISTINCT word)), ' ') AS words FROM k WHERE word IN (SELECT word FROM n) AND word NOT IN (SELECT word FROM h) GROUP BY key)"""
_WORDS = "[lower(w) for w in regexp_extract_all({c}, '[A-Za-z][A-Za-z''-]*')]"
_HIT = "array_to_string(list_sort([w for w in ['engine', 'electron', 'telephone', 'isotope', 'radio', 'orchestra'] if list_contains({w}, w)]), ' ')"
_PHRASE = "array_to_string([f for f in ['of the', 'at all', 'in the same', 'news of it'] if contains(' ' || array_to_string({w}, ' ') || ' ', ' ' || f || ' ')], '|')"
_PCT = "round_even(coalesce(100.0::DOUBLE * flagged / nullif(texts, 0), 0.0), 2) AS pct"

SQL = {
    "period_words": f"WITH {_BEYOND} SELECT key, words FROM b",
    "barred_words": f"WITH d AS (SELECT doc_id, {_WORDS.format(c='text')} AS ws FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, {_HIT.format(w='ws')} AS words, {_PHRASE.format(w='ws')} AS phrases FROM d) SELECT * FROM h WHERE words <> '' OR phrases <> ''",
    "period_scan": f"""WITH {_BEYOND}, s AS (SELECT [lower(w) for w in ws] AS lw FROM t), m AS (SELECT 'words' AS check, count(*) FILTER (WHERE {_HIT.format(w='lw')} <> '') AS flagged, count(*) AS texts FROM s
        UNION ALL SELECT 'phrases', count(*) FILTER (WHERE {_PHRASE.format(w='lw')} <> ''), count(*) FROM s UNION ALL SELECT 'out_of_period', (SELECT count(*) FROM b), count(*) FROM s) SELECT *, {_PCT} FROM m""",
    "category_profile": """WITH m AS (SELECT topic_or_subject_gen, topic_or_subject_score_gen AS c, year AS y, word_count AS w FROM doc_meta), l AS (SELECT topic_or_subject_gen, count(*) AS documents, min(c) AS confidence_min, count(*) FILTER (WHERE c < 0.5) AS suspect, min(y) AS year_min, max(y) AS year_max,
        list_sort(list(c) FILTER (WHERE c IS NOT NULL)) AS cs, list_sort(list(y) FILTER (WHERE y IS NOT NULL)) AS ys, list_sort(list(w) FILTER (WHERE w IS NOT NULL)) AS ws FROM m GROUP BY 1)
        SELECT topic_or_subject_gen, documents, confidence_min, suspect, year_min, year_max, cs[CAST(floor(0.5::DOUBLE * (len(cs) - 1)) AS BIGINT) + 1] AS confidence_p50, ys[CAST(floor(0.5::DOUBLE * (len(ys) - 1)) AS BIGINT) + 1] AS year_p50,
        ws[CAST(floor(0.5::DOUBLE * (len(ws) - 1)) AS BIGINT) + 1] AS size_p50, ws[CAST(floor(0.9::DOUBLE * (len(ws) - 1)) AS BIGINT) + 1] AS size_p90 FROM l""",
    "relabel_delta": f"""WITH d AS (SELECT affordance, excerpt, {signal_sql.doubled('excerpt')} AS doubled FROM excerpts), s AS (SELECT affordance, excerpt, {signal_sql.signals('excerpt')} FROM d),
        n AS (SELECT affordance AS before, CASE WHEN excerpt IS NOT NULL THEN {signal_sql.label()} END AS after FROM s) SELECT before, after, count(*) AS n FROM n WHERE before IS DISTINCT FROM after GROUP BY ALL""",
    "grade_analysis": """WITH g AS (SELECT route, score, coalesce(warnings, []) AS w FROM graded_rows WHERE score IS NOT NULL), c AS (SELECT route, score, w, len([x for x in w if contains(x, 'question contains the answer proposition') OR contains(x, 'unbalanced ') OR contains(x, 'dramatic speaker labels flattened into prose')
            OR contains(x, 'probable OCR-split words') OR contains(x, 'answer appears to end mid-sentence or mid-structure')]) > 0 AS capped FROM g),
        e AS (SELECT route, score, unnest([x for x in ['all', CASE WHEN len(w) = 0 THEN 'clean' ELSE 'flagged' END, CASE WHEN capped THEN 'capped' END] if x IS NOT NULL]) AS subset FROM c)
        SELECT route, subset, count(*) AS n, round_even(avg(score), 1) AS mean, median(score) AS median, min(score) AS low, max(score) AS high, count(*) FILTER (WHERE score >= 90) AS b90, count(*) FILTER (WHERE score >= 75 AND score < 90) AS b75, count(*) FILTER (WHERE score >= 50 AND score < 75) AS b50, count(*) FILTER (WHERE score < 50) AS below50 FROM e GROUP BY ALL""",
    "warning_histogram": "WITH w AS (SELECT route, unnest(warnings) AS w FROM graded_rows WHERE score IS NOT NULL) SELECT route, string_split(w, ':')[1] AS warning, count(*) AS n FROM w GROUP BY ALL",
    "judge_summary": """WITH j AS (SELECT route, CAST(floor(score / 20) AS INT) AS a, CAST(least(floor(length(answer) / 40), 5) AS INT) AS p FROM graded_rows)
        SELECT route, count(*) AS n, round_even(avg(a), 6) AS answered, round_even(avg(p), 6) AS period, round_even(count(*) FILTER (WHERE a >= 4 AND p >= 4)::DOUBLE / count(*), 6) AS both4, round_even(count(*) FILTER (WHERE a <= 2)::DOUBLE / count(*), 6) AS answered2, round_even(count(*) FILTER (WHERE p <= 2)::DOUBLE / count(*), 6) AS period2
        FROM j WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY route""",
    "bleed_retry": f"SELECT coalesce(source, '-') AS dataset, count(*) AS n FROM documents WHERE regexp_matches(text, '{signal_sql._NUMBERED}') AND doc_id % 7 <> 0 GROUP BY 1",
    "route_pools": f"""WITH e AS (SELECT doc_index, any_value(excerpt) AS excerpt, any_value(classes) AS classes, any_value(prose_score) AS ps FROM excerpts WHERE excerpt IS NOT NULL GROUP BY doc_index),
        o AS (SELECT doc_index, row_number() OVER (ORDER BY md5('0:' || doc_index), doc_index) AS r, count(*) OVER () AS n FROM e WHERE coalesce(ps, 0) >= 0.7 AND list_contains(classes, 'knowledge') AND NOT regexp_matches(excerpt, '=[{signal_sql.SPACE}]*=|[=×÷][{signal_sql.SPACE}]*[·;]|[·;][{signal_sql.SPACE}]*='))
        SELECT 'knowledge_qa' AS route, count(*) AS n FROM o WHERE r <= CAST(floor(n * 0.45::DOUBLE) AS BIGINT) UNION ALL SELECT 'multiturn_qa', count(*) FROM o WHERE r > CAST(floor(n * 0.30::DOUBLE) AS BIGINT)""",
}
