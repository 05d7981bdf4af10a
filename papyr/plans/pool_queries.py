"""Queries of sequences, samples, pools, grades and vectors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyr.operators import generate, sampling, sequence, stats
from papyr.passes import verdicts
from papyr.session import table
from papyr.sources import files


def _pairs(spark: SparkSession, base: str) -> DataFrame:
    """One row for each key of ``pairs``, the latest delivery; deliveries at the same time are alike or fall to the greater text."""
    p = table(spark, base, "pairs")
    last = p.groupBy("dataset", "i").agg(F.max(F.struct("ingested_at", F.coalesce("q", F.lit("")).alias("q"), F.coalesce("a", F.lit("")).alias("a"))).alias("v"))
    return last.select("dataset", "i", F.col("v.q").alias("q"), F.col("v.a").alias("a"))


def _turns(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "conversations_nested")


def chain_lengths(spark, base):
    p = _pairs(spark, base).withColumn("depends", F.length("q") % 3 == 0)
    return sequence.conversations(sequence.chains(p)).groupBy("dataset").agg(F.count(F.lit(1)).alias("chains"), F.count_if("chained").alias("chained"), F.max(F.size("conversations")).alias("longest"))


def attached(spark, base):
    p = _pairs(spark, base).withColumn("status", F.when(F.length("q") % 4 == 0, "bare").otherwise("clear"))
    return sequence.attach(p).groupBy("dataset", "output").agg(F.count(F.lit(1)).alias("rows"), F.min("i").alias("first_i"))


def window_context(spark, base):
    w = sequence.pair_windows(_pairs(spark, base), 50)
    return w.select("dataset", "i", "w", "pos", F.md5("context.q").alias("context_q"))


def batches(spark, base):
    p = _pairs(spark, base).withColumn("tokens", F.floor((F.length("q") + F.length("a")) / 4).cast("long"))
    b = sequence.greedy_batches(p, "tokens", 1200, "dataset", "i")
    return b.groupBy("dataset", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens"), F.min("i").alias("first_i"))


def capped_batches(spark, base):
    p = _pairs(spark, base).withColumn("chars", (F.length("q") + F.length("a")).cast("long"))
    b = sequence.greedy_batches(p, "chars", 6000, "dataset", "i", 40)
    return b.groupBy("dataset", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.min("i").alias("first_i"))


def opening_pairs(spark, base):
    p = files.pairs_of_conversations(_turns(spark, base))
    return p.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("q")).alias("q_chars"), F.sum(F.length("a")).alias("a_chars"))


def histories(spark, base):
    h = _turns(spark, base).withColumn("turns", F.filter("conversations", lambda t: t["role"] != "system")).select("dataset", "i", F.posexplode(sequence.with_history(F.col("turns"))).alias("k", "x"))
    return h.groupBy("dataset", "k").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("x.question")).alias("chars"))


def prefixes(spark, base):
    t = _turns(spark, base)
    n = sequence.alternating_prefix(F.transform("conversations", lambda x: x["role"]))
    return t.groupBy(n.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def conversation_texts(spark, base):
    t = _turns(spark, base)
    return t.groupBy("dataset").agg(F.sum(F.length(sequence.as_text(F.col("conversations")))).alias("chars"), F.sum(F.floor(F.length(sequence.as_text(F.col("conversations"))) / 4)).cast("long").alias("tokens"))


def quotas(spark, base):
    d = table(spark, base, "doc_meta").where(F.coalesce("topic_or_subject_score_gen", F.lit(0.0)) >= 0.5)
    n = d.groupBy(F.coalesce(F.col("topic_or_subject_gen"), F.lit("UNKNOWN")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return sampling.tempered_quotas(n.where("category <> 'UNKNOWN'"), 500)


def filled(spark, base):
    d = table(spark, base, "documents").where(F.col("source").isNotNull())
    n = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return sampling.fill_quotas(d.select("doc_id", "source"), sampling.tempered_quotas(n, 200, category="source"), "source", "doc_id")


def sampled(spark, base):
    """Twenty documents in seeded order."""
    return sampling.sample(table(spark, base, "documents").select("doc_id", "source"), 20, "doc_id", 7)


def slices(spark, base):
    return sampling.two_slices(table(spark, base, "documents").select("doc_id"), "doc_id", seed=3).groupBy("in_first", "in_second").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def exchanges(spark, base):
    return table(spark, base, "excerpts").where(F.col("doc_index").isNotNull()).select("doc_index").distinct().groupBy(sampling.target_exchanges(F.col("doc_index")).alias("target")).agg(F.count(F.lit(1)).alias("n"))


def primary(spark, base):
    e = table(spark, base, "excerpts")
    return e.groupBy(sequence.primary_class(F.col("classes"), stats.CLAIM_ORDER).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def class_coverage(spark, base):
    return stats.class_report(table(spark, base, "excerpts"))


def confusion(spark, base):
    e = table(spark, base, "excerpts")
    return e.groupBy(F.coalesce("affordance", F.lit("-")).alias("affordance"), F.coalesce("primary_class", F.lit("-")).alias("primary_class")).agg(F.count(F.lit(1)).alias("n"))


def _graded(spark, base):
    g = table(spark, base, "graded_rows")
    last = g.groupBy("row_id").agg(F.max(F.struct("ingested_at", "route", "score")).alias("v"))
    return last.select("row_id", F.col("v.route").alias("route"), F.col("v.score").alias("score"))


def ranked_cut(spark, base):
    c = sequence.ranked_cut(_graded(spark, base), "score", 0.05, "row_id")
    return c.groupBy("dropped").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


def top_fraction(spark, base):
    c = sequence.top_fraction_drop(_graded(spark, base), "score", 0.1, "row_id")
    return c.groupBy("dropped").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


def grade_bands(spark, base):
    return stats.grade_summary(_graded(spark, base), ["route"])


def grade_percentiles(spark, base):
    return stats.exact_percentiles(_graded(spark, base), ["route"], "score", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def grade_warnings(spark, base):
    """The structural defects of answers, as rows of the knowledge route."""
    p = table(spark, base, "pairs").select(F.explode(stats.warnings(F.col("q"), F.col("a"), F.lit("knowledge_qa"))).alias("warning"))
    return p.groupBy("warning").agg(F.count(F.lit(1)).alias("n"))


def warning_caps(spark, base):
    g = table(spark, base, "graded_rows").select("row_id", stats.warning_cap(F.col("warnings")).alias("cap"))
    return g.groupBy("cap").agg(F.count(F.lit(1)).alias("n"))


def misaligned(spark, base):
    g = _graded(spark, base).withColumn("value", F.when(F.col("score").isNotNull(), F.when(F.col("score") >= 50, 1).otherwise(0)))
    return verdicts.misaligned(g.where(F.col("route").isNotNull()))


def mismatches(spark, base):
    """Answers set beside other pairs' answers, by dataset."""
    p = _pairs(spark, base).withColumn("key", F.concat_ws("--", "dataset", F.col("i").cast("string")))
    return sampling.mismatched(p, "key", "a").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def excerpt_pool(spark, base):
    e = files.load_excerpts(table(spark, base, "excerpts").where(F.col("excerpt").isNotNull()), classes=["knowledge", "reasoning"], floor=0.7, sound_math=True)
    return e.groupBy("affordance").agg(F.count(F.lit(1)).alias("n"))


def route_sources(spark, base):
    """How many excerpts each route may use."""
    e = table(spark, base, "excerpts").where(F.col("excerpt").isNotNull()).select("doc_index", "classes", "prose_score", "excerpt", "affordance")
    return e.select("doc_index", F.explode(verdicts.routes_of(0.7)).alias("route")).groupBy("route").agg(F.countDistinct("doc_index").alias("n"))


def shard_offsets(spark, base):
    m = table(spark, base, "documents").where(F.col("shard").isNotNull()).groupBy(F.col("shard").alias("index")).agg(F.count(F.lit(1)).alias("num_docs"))
    return files.offsets(m)


def located(spark, base):
    d = table(spark, base, "documents")
    return files.locate(d.select("doc_id"), "doc_id", shard_offsets(spark, base)).groupBy(F.coalesce("shard", F.lit(-1)).alias("shard")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("local"), F.lit(-1).cast("long")).alias("last"))


def unaligned(spark, base):
    meta = table(spark, base, "doc_meta").where(F.col("shard").isNotNull())
    return files.misaligned_shards(meta, shard_offsets(spark, base).select("index", "num_docs"))


def not_harvested(spark, base):
    """Documents that have no excerpt yet, by source."""
    done = table(spark, base, "excerpts").select(F.col("doc").alias("key"))
    d = table(spark, base, "documents").select("doc_id", F.coalesce("source", F.lit("-")).alias("source"))
    return files.not_pushed(d, "doc_id", done, F.lit(True)).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def pool_fit(spark, base):
    """What is usable of each route's rows when 1.5 percent are held out."""
    n = _graded(spark, base).where(F.col("route").isNotNull()).groupBy("route").agg(F.count(F.lit(1)).alias("pool"))
    return n.withColumn("usable", F.col("pool") - F.ceil(F.col("pool") * 0.015).cast("long")).withColumn("short", F.col("usable") < 100)


def ranked_runs(spark, base):
    """Users as runs: mean, least and best value of their events, ranked by the mean."""
    e = table(spark, base, "events").groupBy("user_id").agg(F.bround(F.avg("value"), 4).alias("mean"), F.min("value").alias("least"), F.max_by("event_type", F.struct("value", "event_id")).alias("best"))
    return e.orderBy("mean", "user_id").limit(25)


def clause_counts(spark, base):
    pats = {"said": r"\b(said the [a-z]+)\b", "once": r"\b(not once but [a-z]+ times)\b", "cost": r"\b(although the cost was [a-z]+)\b"}
    return generate.clauses(table(spark, base, "documents").where(F.col("text").isNotNull()), "text", pats, ["said the widow"])


def group_centroids(spark, base):
    e = table(spark, base, "embeddings")
    c = stats.centroids(e, "label", "embedding")
    cos = e.join(F.broadcast(c), "label").select("label", stats.cosine(F.col("embedding"), F.col("centroid")).alias("cos"))
    return cos.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg("cos"), 4).alias("cosine"))


def variance(spark, base):
    v = stats.variance_shares(table(spark, base, "embeddings"), "label", "embedding")
    return v.select(F.bround("between", 5).alias("between_var"), F.bround("total", 5).alias("total_var"), F.bround("share", 5).alias("share"))


def auc(spark, base):
    e = table(spark, base, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("score"), F.when(F.col("label") % 2 == 1, 1).otherwise(0).alias("y"))
    return stats.rank_auc(e, "score", "y", "vec_id").select(F.bround("auc", 6).alias("auc"))


def unparseable(spark, base):
    sentences = ["When the tide had turned, the captain gave the order to weigh anchor at once.", "What reason can be given for the colour of the evening sky?"]
    return generate.unparseable(spark, 300, sentences, ["I do not follow you", "there is no such word", "I cannot make out your meaning"], ["what do you mean", "pray say it again", "how is that"])


def typing_errors(spark, base):
    return generate.typos(_pairs(spark, base).withColumn("key", F.concat_ws("--", "dataset", F.col("i").cast("string"))), 300, "key", "q")


QUERIES = {
    "chain_lengths": chain_lengths, "attached": attached, "window_context": window_context, "batches": batches, "capped_batches": capped_batches, "opening_pairs": opening_pairs, "histories": histories, "prefixes": prefixes, "conversation_texts": conversation_texts,
    "quotas": quotas, "filled_quotas": filled, "sampled": sampled, "slices": slices, "exchanges": exchanges, "primary_classes": primary, "class_coverage": class_coverage, "class_confusion": confusion, "ranked_cut": ranked_cut, "top_fraction": top_fraction,
    "grade_bands": grade_bands, "grade_percentiles": grade_percentiles, "grade_warnings": grade_warnings, "warning_caps": warning_caps, "misaligned": misaligned, "mismatches": mismatches, "excerpt_pool": excerpt_pool, "route_sources": route_sources,
    "shard_offsets": shard_offsets, "located": located, "unaligned_shards": unaligned, "not_harvested": not_harvested, "pool_fit": pool_fit, "ranked_runs": ranked_runs, "clause_counts": clause_counts, "group_centroids": group_centroids, "variance_shares": variance, "rank_auc": auc,
    "unparseable": unparseable, "typing_errors": typing_errors,
}

_P = """p AS (SELECT dataset, i, v.q AS q, v.a AS a FROM (SELECT dataset, i, max(struct_pack(t := ingested_at, q := coalesce(q, ''), a := coalesce(a, ''))) AS v FROM pairs GROUP BY dataset, i))"""
_G = """g AS (SELECT row_id, v.route AS route, v.score AS score FROM (SELECT row_id, max(struct_pack(t := ingested_at, route := route, score := score)) AS v FROM graded_rows GROUP BY row_id))"""


def _greedy(size: str, budget: int, most: int) -> str:
    return f"""
        WITH RECURSIVE {_P}, s AS (SELECT dataset, i, {size} AS z, row_number() OVER (PARTITION BY dataset ORDER BY i) AS r FROM p),
        f AS (SELECT dataset, r, i, z, z AS run, 1 AS n, 0 AS batch FROM s WHERE r = 1 UNION ALL
            SELECT s.dataset, s.r, s.i, s.z, CASE WHEN f.run + s.z > {budget} OR f.n >= {most} THEN s.z ELSE f.run + s.z END, CASE WHEN f.run + s.z > {budget} OR f.n >= {most} THEN 1 ELSE f.n + 1 END, f.batch + CASE WHEN f.run + s.z > {budget} OR f.n >= {most} THEN 1 ELSE 0 END
            FROM f JOIN s ON s.dataset = f.dataset AND s.r = f.r + 1)"""


_FILTERED = "[t for t in conversations if t.role <> 'system']"
_ORDER = "['" + "', '".join(stats.CLAIM_ORDER) + "']"
_QUOTA = "CASE class " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in stats.QUOTAS.items()) + " ELSE 0 END"

SQL = {
    "chain_lengths": f"""WITH {_P}, s AS (SELECT dataset, i, CASE WHEN length(q) % 3 = 0 AND row_number() OVER (PARTITION BY dataset ORDER BY i) > 1 THEN 0 ELSE 1 END AS b FROM p),
        c AS (SELECT dataset, i, sum(b) OVER (PARTITION BY dataset ORDER BY i) AS chain FROM s), n AS (SELECT dataset, chain, count(*) AS k FROM c GROUP BY ALL)
        SELECT dataset, count(*) AS chains, count(*) FILTER (WHERE k > 1) AS chained, 2 * max(k) AS longest FROM n GROUP BY dataset""",
    "attached": f"""WITH {_P}, s AS (SELECT dataset, i, CASE WHEN length(q) % 4 = 0 AND row_number() OVER (PARTITION BY dataset ORDER BY i) > 1 THEN 0 ELSE 1 END AS b FROM p),
        c AS (SELECT dataset, i, CAST(sum(b) OVER (PARTITION BY dataset ORDER BY i) - 1 AS BIGINT) AS output FROM s) SELECT dataset, output, count(*) AS rows, min(i) AS first_i FROM c GROUP BY ALL""",
    "window_context": f"""WITH {_P}, s AS (SELECT dataset, i, q, row_number() OVER (PARTITION BY dataset ORDER BY i) - 1 AS n, lag(q) OVER (PARTITION BY dataset ORDER BY i) AS before FROM p),
        c AS (SELECT *, n // 50 AS w, n % 50 AS pos FROM s) SELECT dataset, i, w, pos, md5(max(CASE WHEN pos = 0 THEN before END) OVER (PARTITION BY dataset, w)) AS context_q FROM c""",
    "batches": _greedy("(length(q) + length(a)) // 4", 1200, 2**31 - 1) + " SELECT dataset, batch, count(*) AS n, CAST(sum(z) AS BIGINT) AS tokens, min(i) AS first_i FROM f GROUP BY ALL",
    "capped_batches": _greedy("length(q) + length(a)", 6000, 40) + " SELECT dataset, batch, count(*) AS n, CAST(sum(z) AS BIGINT) AS chars, min(i) AS first_i FROM f GROUP BY ALL",
    "opening_pairs": """WITH o AS (SELECT dataset, [t.content for t in conversations if t.role = 'user'][1] AS q, [t.content for t in conversations if t.role = 'assistant'][1] AS a FROM conversations_nested)
        SELECT dataset, count(*) AS n, CAST(sum(length(q)) AS BIGINT) AS q_chars, CAST(sum(length(a)) AS BIGINT) AS a_chars FROM o WHERE q IS NOT NULL AND a IS NOT NULL GROUP BY dataset""",
    "histories": f"""WITH t AS (SELECT dataset, i, {_FILTERED} AS c FROM conversations_nested), k AS (SELECT dataset, i, c, unnest(range(0, len(c) // 2)) AS k FROM t),
        h AS (SELECT dataset, k, CASE WHEN k = 0 THEN length(coalesce(c[1].content, '')) ELSE list_sum([length(coalesce(x.content, '')) + CASE WHEN x.role = 'user' THEN 6 ELSE 11 END for x in c[1:2 * k + 1]]) + 2 * k END AS n FROM k)
        SELECT dataset, k, count(*) AS n, CAST(sum(n) AS BIGINT) AS chars FROM h GROUP BY ALL""",
    "prefixes": """WITH r AS (SELECT [t.role for t in conversations] AS r FROM conversations_nested), b AS (SELECT r, [i for i in range(0, len(r)) if r[i + 1] is distinct from (CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END)] AS bad FROM r),
        n AS (SELECT coalesce(bad[1], len(r)) AS n FROM b) SELECT n - n % 2 AS prefix, count(*) AS n FROM n GROUP BY 1""",
    "conversation_texts": """WITH x AS (SELECT dataset, array_to_string([upper(coalesce(t.role, '')) || ': ' || coalesce(t.content, '') for t in conversations], chr(10)) AS s FROM conversations_nested)
        SELECT dataset, CAST(sum(length(s)) AS BIGINT) AS chars, CAST(sum(length(s) // 4) AS BIGINT) AS tokens FROM x GROUP BY dataset""",
    "quotas": """WITH n AS (SELECT topic_or_subject_gen AS category, count(*) AS n FROM doc_meta WHERE coalesce(topic_or_subject_score_gen, 0) >= 0.5 AND coalesce(topic_or_subject_gen, 'UNKNOWN') <> 'UNKNOWN' GROUP BY 1)
        SELECT category, n, least(CAST(round_even(500 * sqrt(n) / sum(sqrt(n)) OVER (), 0) AS BIGINT), n) AS quota FROM n""",
    "filled_quotas": """WITH n AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1), q AS (SELECT source, least(CAST(round_even(200 * sqrt(n) / sum(sqrt(n)) OVER (), 0) AS BIGINT), n) AS quota FROM n),
        r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) AS r FROM documents WHERE source IS NOT NULL) SELECT source, doc_id FROM r JOIN q USING (source) WHERE r <= quota""",
    "sampled": "SELECT doc_id, source FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 20",
    "slices": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('3:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents), s AS (SELECT doc_id, r <= CAST(floor(n * 0.45) AS BIGINT) AS in_first, r > CAST(floor(n * 0.30) AS BIGINT) AS in_second FROM r)
        SELECT in_first, in_second, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM s GROUP BY ALL""",
    "exchanges": """WITH u AS (SELECT CAST('0x' || substring(md5('0:exchanges:' || doc_index), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM (SELECT DISTINCT doc_index FROM excerpts WHERE doc_index IS NOT NULL))
        SELECT CASE WHEN u < 0.46 THEN 2 WHEN u < 0.77 THEN 3 WHEN u < 0.885 THEN 4 ELSE 5 END AS target, count(*) AS n FROM u GROUP BY 1""",
    "primary_classes": f"WITH c AS (SELECT coalesce([c for c in {_ORDER} if list_contains(coalesce(classes, []), c)][1], 'drop') AS class FROM excerpts) SELECT class, count(*) AS n FROM c GROUP BY class",
    "class_coverage": f"""WITH l AS (SELECT class, count(*) AS labelled FROM (SELECT unnest(list_distinct(classes)) AS class FROM excerpts) GROUP BY class), p AS (SELECT class, count(*) AS primary_n FROM (SELECT coalesce([c for c in {_ORDER} if list_contains(coalesce(classes, []), c)][1], 'drop') AS class FROM excerpts) GROUP BY class),
        j AS (SELECT coalesce(l.class, p.class) AS class, coalesce(labelled, 0) AS labelled, coalesce(primary_n, 0) AS primary_n FROM l FULL JOIN p ON l.class = p.class) SELECT class, labelled, primary_n, {_QUOTA} AS quota, greatest({_QUOTA} - primary_n, 0) AS short FROM j""",
    "class_confusion": "SELECT coalesce(affordance, '-') AS affordance, coalesce(primary_class, '-') AS primary_class, count(*) AS n FROM excerpts GROUP BY ALL",
    "ranked_cut": f"WITH {_G}, r AS (SELECT row_id, score IS NOT NULL AND row_number() OVER (ORDER BY score NULLS LAST, row_id) <= CAST(floor(count(score) OVER () * 0.05) AS BIGINT) AS dropped FROM g) SELECT dropped, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM r GROUP BY dropped",
    "top_fraction": f"""WITH {_G}, k AS (SELECT CAST(floor(count(score) * 0.1) AS BIGINT) AS k FROM g), t AS (SELECT min(score) AS t FROM (SELECT score, row_number() OVER (ORDER BY score DESC) AS r FROM g WHERE score IS NOT NULL) WHERE r <= (SELECT k FROM k)),
        r AS (SELECT row_id, score >= (SELECT t FROM t) AS above, count(*) FILTER (WHERE score >= (SELECT t FROM t)) OVER (ORDER BY row_id) AS c FROM g) SELECT coalesce(above AND c <= (SELECT k FROM k), false) AS dropped, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM r GROUP BY 1""",
    "grade_bands": f"WITH {_G} SELECT route, count(*) AS n, round_even(avg(score), 3) AS mean, count(*) FILTER (WHERE score >= 90) AS b90, count(*) FILTER (WHERE score BETWEEN 75 AND 89) AS b75, count(*) FILTER (WHERE score BETWEEN 50 AND 74) AS b50, count(*) FILTER (WHERE score < 50) AS below50 FROM g WHERE score IS NOT NULL GROUP BY route",
    "grade_percentiles": f"WITH {_G}, l AS (SELECT route, list_sort(list(score)) AS v, count(*) AS n FROM g WHERE score IS NOT NULL GROUP BY route) SELECT route, n, v[CAST(floor(0.1::DOUBLE * (n - 1)) AS BIGINT) + 1] AS p10, v[CAST(floor(0.5::DOUBLE * (n - 1)) AS BIGINT) + 1] AS p50, v[CAST(floor(0.9::DOUBLE * (n - 1)) AS BIGINT) + 1] AS p90 FROM l",
    "misaligned": f"WITH {_G}, v AS (SELECT route, CASE WHEN score >= 50 THEN 1 ELSE 0 END AS v FROM g WHERE score IS NOT NULL AND route IS NOT NULL) SELECT coalesce(route, 'ALL') AS route, count(*) AS judged, count(*) FILTER (WHERE v = 0) AS bad, round_even(count(*) FILTER (WHERE v = 0)::DOUBLE / count(*), 6) AS rate FROM v GROUP BY ROLLUP (route)",
    "excerpt_pool": "SELECT affordance, count(*) AS n FROM excerpts WHERE excerpt IS NOT NULL AND list_has_any(classes, ['knowledge', 'reasoning']) AND coalesce(prose_score, 0) >= 0.7 AND NOT regexp_matches(excerpt, '=\\s*=|[=×÷]\\s*[·;]|[·;]\\s*=') GROUP BY affordance",
    "shard_offsets": "WITH m AS (SELECT shard AS index, count(*) AS num_docs FROM documents WHERE shard IS NOT NULL GROUP BY shard) SELECT index, num_docs, CAST(coalesce(sum(num_docs) OVER (ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM m",
    "located": """WITH m AS (SELECT shard AS index, count(*) AS num_docs FROM documents WHERE shard IS NOT NULL GROUP BY shard), o AS (SELECT index, num_docs, CAST(coalesce(sum(num_docs) OVER (ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM m)
        SELECT coalesce(index, -1) AS shard, count(*) AS n, coalesce(max(doc_id - start), -1) AS last FROM documents LEFT JOIN o ON doc_id >= start AND doc_id < start + num_docs GROUP BY index""",
    "unaligned_shards": """WITH m AS (SELECT shard, count(*) AS e FROM documents WHERE shard IS NOT NULL GROUP BY shard), f AS (SELECT shard, count(*) AS f FROM doc_meta WHERE shard IS NOT NULL GROUP BY shard)
        SELECT coalesce(m.shard, f.shard) AS shard, coalesce(e, 0) AS expected, coalesce(f, 0) AS found FROM m FULL JOIN f ON m.shard = f.shard WHERE e IS DISTINCT FROM f""",
    "not_harvested": "SELECT coalesce(source, '-') AS source, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc FROM excerpts WHERE doc IS NOT NULL) GROUP BY 1",
    "pool_fit": f"WITH {_G}, n AS (SELECT route, count(*) AS pool FROM g WHERE route IS NOT NULL GROUP BY route) SELECT route, pool, pool - CAST(ceil(pool * 0.015::DOUBLE) AS BIGINT) AS usable, pool - CAST(ceil(pool * 0.015::DOUBLE) AS BIGINT) < 100 AS short FROM n",
    "ranked_runs": "SELECT user_id, round_even(avg(value), 4) AS mean, min(value) AS least, max_by(event_type, struct_pack(v := value, e := event_id)) AS best FROM events GROUP BY user_id ORDER BY mean, user_id LIMIT 25",
    "clause_counts": r"""WITH c AS (SELECT 'said' AS kind, unnest(regexp_extract_all(text, '\b(said the [a-z]+)\b', 1)) AS clause FROM documents UNION ALL SELECT 'once', unnest(regexp_extract_all(text, '\b(not once but [a-z]+ times)\b', 1)) FROM documents
        UNION ALL SELECT 'cost', unnest(regexp_extract_all(text, '\b(although the cost was [a-z]+)\b', 1)) FROM documents) SELECT kind, lower(clause) AS clause, count(*) AS n FROM c WHERE lower(clause) <> 'said the widow' GROUP BY ALL HAVING count(*) >= 2""",
    "group_centroids": """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), c AS (SELECT label, d, avg(x) AS m FROM x GROUP BY ALL),
        s AS (SELECT vec_id, x.label, sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))) AS cos FROM x JOIN c ON c.label = x.label AND c.d = x.d GROUP BY ALL) SELECT label, count(*) AS n, round_even(avg(cos), 4) AS cosine FROM s GROUP BY label""",
    "variance_shares": """WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), p AS (SELECT label, d, count(*) AS n, avg(x) AS m FROM x GROUP BY ALL), g AS (SELECT d, avg(x) AS mu, var_pop(x) AS v FROM x GROUP BY d),
        b AS (SELECT p.d, sum(n * (m - mu) ** 2) / sum(n) AS b FROM p JOIN g ON g.d = p.d GROUP BY p.d) SELECT round_even(sum(b), 5) AS between_var, round_even(sum(v), 5) AS total_var, round_even(sum(b) / sum(v), 5) AS share FROM b JOIN g ON g.d = b.d""",
    "rank_auc": """WITH r AS (SELECT label % 2 = 1 AS y, row_number() OVER (ORDER BY embedding[1]::DOUBLE, vec_id) AS r FROM embeddings) SELECT round_even((sum(r) FILTER (WHERE y) - count(*) FILTER (WHERE y) * (count(*) FILTER (WHERE y) + 1) / 2.0::DOUBLE) / (count(*) FILTER (WHERE y) * count(*) FILTER (WHERE NOT y)), 6) AS auc FROM r""",
}
