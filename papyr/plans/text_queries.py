"""Queries of text signals and normalisation over documents, excerpts, pairs and conversations, with SQL that says the same in RE2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyr.functions import normalise as N
from papyr.functions import repair as R
from papyr.functions import signals as S
from papyr.operators import extract as X
from papyr.operators import stats, windows
from papyr.session import spread, table

# ---- SQL of the same patterns: RE2 has no look-around and no Unicode word boundaries --------------------

SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\pL\pM\p{Nd}\p{Pc}\x{200C}\x{200D}"
DOUBLED = rf"regexp_replace(replace(lower(text), 'ſ', 's'), '([^{WORD}])', '\1\1', 'g')"
FOLDED = f"regexp_replace(text, '[{SPACE}]+', ' ', 'g')"


def words_sql(alternatives: str) -> str:
    """How often one of the alternatives stands as a whole word in ``doubled``, where every sign between words stands twice."""
    return f"len(regexp_extract_all(doubled, '(?:^|[^{WORD}])(?:{alternatives.replace(' ', '  ')})(?:[^{WORD}]|$)'))"


def tokens_sql(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{SPACE}]+')"


_SENTENCES = rf"""string_split(regexp_replace(trim({FOLDED}), '([.!?])\s+(["''(]?[A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1))"""
_STOP = "(" + ", ".join(f"'{w}'" for w in dict.fromkeys(S.STOP_WORDS)) + ")"


def _docs(spark: SparkSession, base: str) -> DataFrame:
    return spread(table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", "text"))


def doc_char_counts(spark, base):
    c = F.col("text")
    return _docs(spark, base).select("doc_id", S.count(c, r"\p{L}").alias("letters"), S.count(c, r"\p{Nd}").alias("figures"), F.length(F.regexp_replace(c, r"(?U)\s", "")).alias("solid"), S.word_count(c).alias("tokens"))


def gibberish(spark, base):
    c = F.col("text")
    return _docs(spark, base).select("doc_id", F.bround(S.gibberish_ratio(c), 6).alias("ratio"), S.foreign_count(c).alias("foreign_n"), S.is_garbage(c).alias("garbage"))


def ocr_scores(spark, base):
    return _docs(spark, base).select("doc_id", S.ocr_score(F.col("text")).alias("score"))


def stripped_lines(spark, base):
    c = S.strip_lines(F.col("text"))
    return _docs(spark, base).select("doc_id", F.size(F.split(c, "\n")).alias("lines"), F.md5(c).alias("digest"))


def sentence_counts(spark, base):
    s = S.sentences(F.col("text"))
    return _docs(spark, base).select("doc_id", F.size(s).alias("sentences"), F.md5(F.array_join(s, "|")).alias("digest"))


def region_quality(spark, base):
    return _docs(spark, base).select("doc_id", F.bround(S.region_quality(F.col("text")), 6).alias("quality"))


def openings(spark, base):
    c = F.col("text")
    return _docs(spark, base).select("doc_id", S.first_word(c).alias("opens"), S.is_self_contained(c).alias("self_contained"), S.has_affordance(c).alias("affords"))


def route_signals(spark, base):
    c = F.col("text")
    return _docs(spark, base).select(
        "doc_id", S.count(c, S.CONNECTIVE).alias("connectives"), S.count(c, S.REASON).alias("reasons"), S.count(c, S.SPEECH).alias("speech"), S.count(c, S.FIRST_PERSON).alias("first_person"), S.count(c, S.PAST).alias("past"),
        F.bround(S.narrative_signal(c), 6).alias("narrative"),
    )


def affordances(spark, base):
    ex = spread(table(spark, base, "excerpts").where(F.col("excerpt").isNotNull()).select("doc_index", "excerpt"))
    c = F.col("excerpt")
    return ex.select("doc_index", S.affordance_label(c).alias("label"), F.bround(S.stem_signal(c), 6).alias("stem"), S.has_calibration_hedge(c).alias("hedge"), F.bround(S.conversational_signal(c), 6).alias("conversational"), S.is_composition(c).alias("composed"))


def dialogues(spark, base):
    ex = table(spark, base, "excerpts").where(F.col("excerpt").isNotNull())
    return ex.select("doc_index", S.is_structured_dialogue(F.col("excerpt")).alias("dialogue"))


def broken_math(spark, base):
    return table(spark, base, "excerpts").where(F.col("excerpt").isNotNull()).groupBy("affordance").agg(F.count_if(S.has_broken_math(F.col("excerpt"))).alias("broken"), F.count(F.lit(1)).alias("n"))


def notation(spark, base):
    c = F.col("text")
    return _docs(spark, base).select("doc_id", S.notation_count(c).alias("n"))


def turn_rules(spark, base):
    conv = table(spark, base, "conversations_nested")
    return conv.select("dataset", F.coalesce(S.conversation_rule(F.col("conversations")), F.lit("clean")).alias("rule")).groupBy("dataset", "rule").agg(F.count(F.lit(1)).alias("n"))


def control_shares(spark, base):
    return _docs(spark, base).select("doc_id", F.bround(S.garbage_ratio(F.col("text")), 6).alias("share"))


def bleed_candidates(spark, base):
    p = table(spark, base, "pairs").where(F.col("q").isNotNull() & F.col("a").isNotNull())
    return p.groupBy("dataset").agg(F.count_if(S.is_bleed_candidate(F.col("q"), F.col("a"))).alias("candidates"), F.sum(S.token_estimate(F.col("q"), F.col("a"))).cast("long").alias("tokens"))


def mapped_characters(spark, base):
    c = N.map_characters(N.strip_controls(F.col("text")))
    return _docs(spark, base).select("doc_id", F.md5(c).alias("digest"), F.length(c).alias("size"))


def confusables(spark, base):
    c = F.col("text")
    fixed = N.fix_confusables(c)
    return _docs(spark, base).select("doc_id", F.size(N.confusable_words(c)).alias("words"), (fixed != c).alias("changed")).where("words > 0")


def mojibake(spark, base):
    return _docs(spark, base).select("doc_id", N.mojibake_count(F.col("text")).alias("n")).where("n > 0")


def top_words(spark, base):
    return _docs(spark, base).select(F.explode(N.word_tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(200)


def trigrams(spark, base):
    return stats.char_trigrams(_docs(spark, base), "text", 250)


def out_of_list(spark, base):
    """Words that the word list lacks, in three documents or more."""
    lex = table(spark, base, "lexicon").select(F.lower("word").alias("word")).where(F.col("word").isNotNull())
    words = _docs(spark, base).select("doc_id", F.explode(F.array_distinct(N.word_tokens(F.col("text")))).alias("word")).where(F.length("word") >= 3)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("docs")).where("docs >= 3").join(lex, "word", "left_anti")


def question_overlap(spark, base):
    p = table(spark, base, "pairs").where(F.col("q").isNotNull() & F.col("a").isNotNull())
    return p.groupBy("dataset").agg(F.bround(F.avg(N.echo(F.col("q"), F.col("a"))), 6).alias("echo"), F.bround(F.avg(N.jaccard(F.col("q"), F.col("a"))), 6).alias("jaccard"), F.count_if(N.is_template(F.col("q"))).alias("templates"), F.sum(F.length("q")).alias("chars"))


def shared_runs(spark, base):
    """The longest run of words that questions share with their answers: mean by dataset."""
    p = table(spark, base, "pairs").where(F.col("q").isNotNull() & F.col("a").isNotNull())
    return p.groupBy("dataset").agg(F.bround(F.avg(stats.longest_shared_run(F.col("q"), F.col("a"))), 6).alias("run"))


def long_words(spark, base):
    return _docs(spark, base).select("doc_id", F.size(S.content_words(F.col("text"))).alias("n"))


def spans_found(spark, base):
    """First sentences of excerpts found again in them, as one and as two spans."""
    ex = table(spark, base, "excerpts").where(F.length(F.trim("excerpt")) > 0)
    first = F.get(S.sentences(F.col("excerpt")), F.lit(0))
    return ex.select("doc_index", F.md5(N.locate_spans(F.array(F.upper(first)), F.col("excerpt"))).alias("one"), N.locate_spans(F.array(first, F.lit("no such words here")), F.col("excerpt")).isNull().alias("rejected"))


def verse(spark, base):
    return windows.verse_windows(_docs(spark, base).select("doc_id", "text"), ["doc_id"])


def stem(spark, base):
    return windows.stem_windows(_docs(spark, base).select("doc_id", "text"), ["doc_id"], floor=0.1)


def prose(spark, base):
    return windows.prose_windows(_docs(spark, base).select("doc_id", "text"), "doc_id", ["doc_id"], words=40, floor=0.5)


def prose_bands(spark, base):
    """Windows in the three bands of length, at the usual floor."""
    return windows.prose_windows(_docs(spark, base), "doc_id", ["doc_id"])


def stem_excerpts(spark, base):
    return windows.stem_excerpt(_docs(spark, base), ["doc_id"])


def calibration(spark, base):
    return windows.calibration_windows(_docs(spark, base).select("doc_id", "text"), "doc_id", ["doc_id"], floor=0.5)


def conversational(spark, base):
    return windows.conversational_windows(_docs(spark, base).select("doc_id", "text"), ["doc_id"], floor=0.2)


def catechism(spark, base):
    """Pairs that documents printed as catechisms hold."""
    return X.extract(_docs(spark, base), "text", "symbological", ["doc_id"])


def corruption(spark, base):
    """Classes of spoilt text in answers, before and after mending."""
    lex = R.Lexicon.of(R.inflected(table(spark, base, "lexicon").where(F.col("word").isNotNull()).select("word")))
    rows = spread(table(spark, base, "pairs").where(F.col("a").isNotNull()).select("dataset", F.col("a").alias("answer")))
    return R.clean_rows(rows, ["answer"], lex).groupBy("dataset").agg(F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("dropped"), F.sum("joined").alias("joined"))


QUERIES = {
    "doc_char_counts": doc_char_counts, "gibberish": gibberish, "ocr_scores": ocr_scores, "stripped_lines": stripped_lines, "sentence_counts": sentence_counts, "region_quality": region_quality, "openings": openings,
    "route_signals": route_signals, "affordances": affordances, "dialogues": dialogues, "broken_math": broken_math, "notation": notation, "turn_rules": turn_rules, "control_shares": control_shares, "bleed_candidates": bleed_candidates,
    "mapped_characters": mapped_characters, "confusables": confusables, "mojibake": mojibake, "top_words": top_words, "trigrams": trigrams, "out_of_list": out_of_list, "question_overlap": question_overlap, "shared_runs": shared_runs,
    "long_words": long_words, "spans_found": spans_found, "verse_windows": verse, "stem_windows": stem, "prose_windows": prose_bands, "short_prose_windows": prose, "stem_excerpts": stem_excerpts, "calibration_windows": calibration, "conversational_windows": conversational, "catechism_pairs": catechism, "corruption_report": corruption,
}


def _mapped_sql() -> str:
    c = r"regexp_replace(text, '[\x00-\x08\x0B-\x1F\x7F-\x{9F}]|\p{Cf}', '', 'g')"
    for k, v in N.CHARACTERS.items():
        c = f"replace({c}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return c


_CONTENT = "(" + ", ".join(f"'{w}'" for w in N.CONTENT_STOP) + ")"
_SET = lambda c: f"list_distinct([w for w in regexp_extract_all(lower({c}), '[a-z]+') if length(w) > 2 and w not in {_CONTENT}])"
_OPENERS = "(" + ", ".join(f"'{w}'" for w in S.REFERRING_OPENERS) + ")"
_TEXT = "FROM documents WHERE text IS NOT NULL"

SQL = {
    "doc_char_counts": rf"SELECT doc_id, length(regexp_replace(text, '[^\pL]', '', 'g')) AS letters, length(regexp_replace(text, '[^\p{{Nd}}]', '', 'g')) AS figures, length(regexp_replace(text, '[{SPACE}]', '', 'g')) AS solid, len({tokens_sql('text')}) AS tokens {_TEXT}",
    "gibberish": rf"""
        WITH t AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+') AS w, length(regexp_replace(text, '[^\x{{3000}}-\x{{30FF}}\x{{3400}}-\x{{9FFF}}\x{{AC00}}-\x{{D7A3}}\x{{F900}}-\x{{FAFF}}\x{{FF00}}-\x{{FFEF}}\x{{FFFD}}\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g')) AS foreign_n {_TEXT}),
        r AS (SELECT doc_id, foreign_n, CASE WHEN len(w) = 0 THEN 0.0 ELSE len([x for x in w if (regexp_matches(x, '[0-9]') and regexp_matches(x, '[A-Za-z]')) or (length(x) >= 4 and not regexp_matches(x, '[aeiouyAEIOUY]'))])::DOUBLE / len(w) END AS v FROM t)
        SELECT doc_id, round_even(v, 6) AS ratio, foreign_n, foreign_n >= 2 OR v > 0.10 AS garbage FROM r""",
    "ocr_scores": rf"""
        WITH t AS (SELECT doc_id, [trim(x, '.,;:()[]"''') for x in {tokens_sql('text')}] AS w {_TEXT})
        SELECT doc_id, CASE WHEN len(w) < 20 THEN 0.0 ELSE round_even(len([x for x in w if x <> '' and (regexp_matches(x, '[=×÷√°∴±≤≥≠∑∏∫]') or (regexp_matches(x, '[\p{{Nd}}²³¹⁰⁴-⁹₀-₉]') and regexp_matches(x, '\pL'))
            or (length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 4 and not regexp_matches(regexp_replace(x, '[^A-Za-z]', '', 'g'), '[aeiouyAEIOUY]')))])::DOUBLE / len(w), 3) END AS score FROM t""",
    "stripped_lines": rf"""
        WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls {_TEXT}),
        k AS (SELECT doc_id, [x for x in ls if (regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g') = '') or not (
            regexp_matches(regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '^[0-9.,;:\-—\s]+$') or regexp_matches(regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '(?i)^[ivxlcdm]{{1,8}}$') or not regexp_matches(x, '\pL')
            or (regexp_matches(regexp_replace(x, '^[{SPACE}]+', '', 'g'), '^[*†‡]') and len({tokens_sql('x')}) <= 12)
            or (len({tokens_sql('x')}) <= 10 and length(regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')) <= 80 and length(regexp_replace(x, '[^\p{{Lu}}]', '', 'g')) > 0.7 * length(regexp_replace(x, '[^\pL]', '', 'g'))))] AS ks FROM l)
        SELECT doc_id, greatest(len(ks), 1) AS lines, md5(array_to_string(ks, chr(10))) AS digest FROM k""",
    "sentence_counts": rf"WITH s AS (SELECT doc_id, [x for x in {_SENTENCES} if x <> ''] AS ss {_TEXT}) SELECT doc_id, len(ss) AS sentences, md5(coalesce(array_to_string(ss, '|'), '')) AS digest FROM s",
    "region_quality": rf"""
        WITH b AS (SELECT doc_id, length(regexp_replace(text, '[{SPACE}]', '', 'g'))::DOUBLE AS solid, length(regexp_replace(text, '[^\pL]', '', 'g')) AS al, length(regexp_replace(text, '[^\p{{Nd}}²³¹⁰⁴-⁹₀-₉]', '', 'g')) AS dg,
            regexp_extract_all(text, '[A-Za-z]+') AS w, len([x for x in {_SENTENCES} if x <> '']) AS ns, len({tokens_sql('text')}) AS nt {_TEXT}),
        c AS (SELECT doc_id, solid, len(w) AS nw, al / solid AS alpha, dg / solid AS digit, len([x for x in w if lower(x) in {_STOP}])::DOUBLE / len(w) AS stop, CASE WHEN ns = 0 THEN 0.0 ELSE nt::DOUBLE / ns END AS msl FROM b)
        SELECT doc_id, CASE WHEN solid = 0 OR nw = 0 THEN 0.0 ELSE round_even((greatest(0.0, least(1.0, (alpha - 0.60) / 0.30)) + greatest(0.0, least(1.0, (0.05 - digit) / 0.05)) + greatest(0.0, least(1.0, (stop - 0.20) / 0.15)) + greatest(0.0, least(1.0, (msl - 8) / 12))) / 4, 6) END AS quality FROM c""",
    "openings": rf"WITH t AS (SELECT doc_id, text, lower(regexp_extract(text, '^[{SPACE}]*([A-Za-z]+)', 1)) AS opens {_TEXT}) SELECT doc_id, opens, opens NOT IN {_OPENERS} AS self_contained, len(regexp_extract_all(text, '\.{{2,}}|_{{2,}}')) < 2 AS affords FROM t",
    "route_signals": rf"""
        WITH t AS (SELECT doc_id, text, {DOUBLED} AS doubled, len({tokens_sql('text')}) AS w {_TEXT}),
        c AS (SELECT doc_id, w, len(regexp_extract_all(text, '["“”‘’]')) AS quotes, {words_sql('therefore|hence|thus|since|because|consequently|whence|accordingly|it follows|for this reason|so that|if|then|let|suppose|assume|given')} AS connectives,
            {words_sql('because|therefore|thus|hence|since|consequently|inasmuch')} AS reasons, {words_sql('said|asked|replied|cried|answered|exclaimed|demanded|told|spoke|quoth')} AS speech, {words_sql('i|we|my|our|me|us')} AS first_person, {words_sql(f'[{WORD}]+ed')} AS past_any,
            len([x for x in regexp_extract_all(text, '[{WORD}]+') if x like '_%ed']) AS past FROM t)
        SELECT doc_id, connectives, reasons, speech, first_person, past, CASE WHEN w < 20 THEN 0.0 ELSE round_even(least(1.0, (speech + CASE WHEN speech > 0 THEN quotes ELSE 0 END)::DOUBLE / w * 12 + past::DOUBLE / w * 2), 6) END AS narrative FROM c""",
    "broken_math": rf"SELECT affordance, count(*) FILTER (WHERE regexp_matches(excerpt, '=[{SPACE}]*=|[=×÷][{SPACE}]*[·;]|[·;][{SPACE}]*=')) AS broken, count(*) AS n FROM excerpts WHERE excerpt IS NOT NULL GROUP BY affordance",
    "notation": rf"""
        WITH t AS (SELECT doc_id, [trim(x, '.,;:!?()[]{{}}"''“”‘’…—-«»') for x in {tokens_sql('text')}] AS w {_TEXT})
        SELECT doc_id, len([x for x in w if x <> '' and not regexp_matches(x, '(?i)^[0-9]+(?:st|nd|rd|th)$') and not regexp_matches(x, '^[A-Za-z]+(?:[''’-][A-Za-z]+)*$')]) AS n FROM t""",
    "control_shares": r"SELECT doc_id, round_even(length(regexp_replace(text, '[^\x00-\x1F\x{80}-\x{9F}]', '', 'g'))::DOUBLE / greatest(length(text), 1), 6) AS share FROM documents WHERE text IS NOT NULL",
    "mapped_characters": f"WITH t AS (SELECT doc_id, {_mapped_sql()} AS c {_TEXT}) SELECT doc_id, md5(c) AS digest, length(c) AS size FROM t",
    "mojibake": r"WITH t AS (SELECT doc_id, len(regexp_extract_all(text, 'Ã[\x{80}-\x{BF}©®¨«»]|â€[\x{99}\x{9C}\x{9D}\x{93}\x{94}]|Â[\x{A0}-\x{BF}]|\x{FFFD}')) AS n FROM documents WHERE text IS NOT NULL) SELECT * FROM t WHERE n > 0",
    "top_words": f"WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word {_TEXT}) SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 200",
    "trigrams": f"WITH g AS (SELECT unnest([substring(lower(text), i, 3) for i in range(1, length(lower(text)) - 1)]) AS gram FROM documents WHERE length(lower(text)) >= 3) SELECT gram, count(*) AS n FROM g GROUP BY gram ORDER BY n DESC, gram LIMIT 250",
    "out_of_list": f"WITH w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word {_TEXT}) SELECT word, count(*) AS docs FROM w WHERE length(word) >= 3 AND word NOT IN (SELECT lower(word) FROM lexicon WHERE word IS NOT NULL) GROUP BY word HAVING count(*) >= 3",
    "question_overlap": rf"""
        WITH p AS (SELECT dataset, q, {_SET('q')} AS x, {_SET('a')} AS y FROM pairs WHERE q IS NOT NULL AND a IS NOT NULL),
        m AS (SELECT dataset, q, CASE WHEN len(x) = 0 THEN 0.0 ELSE len(list_intersect(x, y))::DOUBLE / len(x) END AS e, CASE WHEN len(x) + len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))) END AS j FROM p)
        SELECT dataset, round_even(avg(e), 6) AS echo, round_even(avg(j), 6) AS jaccard, count(*) FILTER (WHERE regexp_matches(lower(q), '^[{SPACE}]*what[{SPACE}]+(?:is|are)(?:[^{WORD}]|$)')) AS templates, CAST(sum(length(q)) AS BIGINT) AS chars FROM m GROUP BY dataset""",
    "long_words": rf"""
        WITH t AS (SELECT doc_id, [lower(regexp_replace(x, '[^A-Za-z]', '', 'g')) for x in {tokens_sql('text')}] AS w {_TEXT}) SELECT doc_id, len([x for x in w if length(x) >= 5 and x not in ('the', 'and', 'that', 'have', 'for', 'not', 'with', 'you', 'this', 'but', 'his', 'from', 'they', 'she', 'her', 'him', 'will', 'what', 'when', 'which', 'there', 'their', 'would', 'could', 'should', 'been', 'were', 'was', 'are', 'its', 'into',
            'than', 'then', 'them', 'these', 'those', 'some', 'such', 'only', 'other', 'any', 'very', 'does', 'did', 'how', 'why', 'who', 'whom', 'whose', 'all', 'can', 'may')]) AS n FROM t""",
}
