"""What a pass asks, what counts as a reply, and what a verdict does to the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyr.functions import normalise as N
from papyr.functions import signals as S
from papyr.operators.sequence import greedy_batches


def requests(rows: DataFrame, key: str, prompt: Column, group: str, order: str, budget: int, most: int | None = None) -> DataFrame:
    """(batch_id, pos, key, prompt): rows packed in order by their estimated tokens, numbered from 0 within a batch."""
    sized = rows.select(F.col(key).cast("string").alias("key"), F.col(group).alias("_g"), F.col(order).alias("_o"), prompt.alias("prompt")).withColumn("_s", S.token_estimate(F.col("prompt")))
    packed = greedy_batches(sized, "_s", budget, "_g", "_o", most)
    at = F.row_number().over(Window.partitionBy("_g", "batch").orderBy("_o")) - 1
    return packed.select(F.concat_ws("/", F.col("_g").cast("string"), F.col("batch").cast("string")).alias("batch_id"), at.alias("pos"), "key", "prompt")


def integer_array(body: Column, low: int, high: int) -> Column:
    """The bare array of whole numbers within bounds that a reply must be, or null: no fractions, booleans, objects or prose."""
    text = N.reply_array(body, strict=True)
    plain = S.has(text, r"^\[\s*(?:-?\d+(?:\s*,\s*-?\d+)*)?\s*\]$")
    got = F.from_json(F.when(plain, text), "array<int>")
    return F.when(~F.exists(got, lambda x: x.isNull() | (x < low) | (x > high)), got)


def by_position(asked: DataFrame, replies: DataFrame, values: Column) -> DataFrame:
    """(key, value): replies matched to requests place by place, all or nothing: a batch whose reply has another length gives none."""
    sizes = asked.groupBy("batch_id").agg(F.count(F.lit(1)).alias("_n"))
    ok = replies.withColumn("_v", values).join(sizes, "batch_id").where(F.size("_v") == F.col("_n")).select("batch_id", "_v")
    return asked.join(ok, "batch_id").select("key", F.get("_v", F.col("pos")).alias("value"))


def by_index(asked: DataFrame, replies: DataFrame, fields: str) -> DataFrame:
    """(key, r): replies that are arrays of objects with an index ``i``; an index out of bounds is ignored, and of several the last counts."""
    arr = F.from_json(N.reply_array(F.col("body")), f"array<struct<i:int,{fields}>>")
    items = replies.select("batch_id", F.posexplode(arr).alias("_at", "r")).where(F.col("r.i") >= 0)
    last = items.groupBy("batch_id", F.col("r.i").alias("pos")).agg(F.max_by("r", "_at").alias("r"))
    return asked.join(last, ["batch_id", "pos"]).select("key", "r")


def unresolved(asked: DataFrame, resolved: DataFrame) -> DataFrame:
    """The requests without a value yet, in batches of half the size: the next round of asking. Single ones that failed are left out."""
    left = asked.join(resolved.select("key"), "key", "left_anti")
    n = F.count(F.lit(1)).over(Window.partitionBy("batch_id"))
    again = left.withColumn("_n", n).where(F.col("_n") > 1)
    half = (F.row_number().over(Window.partitionBy("batch_id").orderBy("pos")) > F.ceil(F.col("_n") / 2)).cast("int")
    named = again.withColumn("batch_id", F.concat_ws(".", "batch_id", half.cast("string"))).drop("_n")
    return named.withColumn("pos", F.row_number().over(Window.partitionBy("batch_id").orderBy("pos")) - 1)


# ---- bleed -------------------------------------------------------------------------------------------


def bleed_verdict(body: Column, q: Column, a: Column) -> Column:
    """struct(status, pairs) of a reply: ``clean`` for anything that can't be read, ``discard``, or the pairs that have both sides; none of those discards."""
    one = F.from_json(F.regexp_extract(body, r"(?s)\{.*\}", 0), "status string, clean boolean, discard boolean, pairs array<struct<q:string,a:string>>")
    good = F.filter(one["pairs"], lambda p: (F.coalesce(F.trim(p["q"]), F.lit("")) != "") & (F.coalesce(F.trim(p["a"]), F.lit("")) != ""))
    whole = F.array(F.struct(q.alias("q"), a.alias("a")))
    none = F.array().cast("array<struct<q:string,a:string>>")
    status = F.when((one["status"] == "discard") | F.coalesce(one["discard"], F.lit(False)), "discard").when(one["pairs"].isNotNull(), F.when(F.size(good) > 0, "pairs").otherwise("discard")).otherwise("clean")
    return F.struct(status.alias("status"), F.when(status == "clean", whole).when(status == "pairs", good).otherwise(none).alias("pairs"))


def apply_bleed(pairs: DataFrame, verdict: str = "verdict") -> DataFrame:
    """(dataset, i, part, q, a): the pairs that verdicts leave; a pair without verdict is discarded."""
    return pairs.where(F.col(verdict).isNotNull()).select("dataset", "i", F.posexplode(F.col(f"{verdict}.pairs")).alias("part", "p")).select("dataset", "i", "part", F.col("p.q").alias("q"), F.col("p.a").alias("a"))


# ---- reading errors -------------------------------------------------------------------------------------


def apply_ocr(pairs: DataFrame, fixed: str = "r", most: int = 2048) -> DataFrame:
    """Pairs with their corrected text, ``changed`` and ``flagged``.

    ``fixed`` is struct(q, a, discard, flagged), null where the judge failed, which keeps the original and flags it. Pairs beyond
    ``most`` estimated tokens are dropped, as are discarded ones.
    """
    r = F.col(fixed)
    q, a = F.coalesce(F.nullif(r["q"], F.lit("")), F.col("q")), F.coalesce(F.nullif(r["a"], F.lit("")), F.col("a"))
    kept = pairs.where(~F.coalesce(r["discard"], F.lit(False)) & (S.token_estimate(F.col("q"), F.col("a")) <= most))
    return kept.withColumns({"_q": q, "_a": a}).withColumns({"changed": ~(F.col("_q").eqNullSafe(F.col("q")) & F.col("_a").eqNullSafe(F.col("a"))), "flagged": r.isNull() | F.coalesce(r["flagged"], F.lit(False))}).withColumns({"q": F.col("_q"), "a": F.col("_a")}).drop("_q", "_a", fixed)


# ---- dependencies -----------------------------------------------------------------------------------------


def dependency_flags(body: Column, size: Column) -> Column:
    """The flags of a window of pairs; all false where the reply is no array of just so many."""
    got = F.from_json(N.reply_array(body), "array<boolean>")
    bad = got.isNull() | (F.size(got) != size) | F.exists(got, lambda x: x.isNull())
    return F.when(bad, F.transform(F.sequence(F.lit(1), size), lambda _: F.lit(False))).otherwise(got)


PRONOUN = r"(?iU)^\W*(?:and|but|then|why so|how so|he|she|it|they|this|that|these|those|what else|is it|was it|are they|do they)\b"


def depends_by_rule(q: Column) -> Column:
    """A stand-in for the judge: a question that opens on a pronoun or connective depends on the one before."""
    return S.has(q, PRONOUN)


# ---- routes -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Route:
    """Which excerpts a route asks about and how its answers are checked."""

    name: str
    classes: tuple[str, ...]
    spans: int
    phases: int = 1
    answer: str = "verbatim"  # or refurbished, verse, turns
    broken_math: bool = False
    hedge: bool = False
    pool: str = ""  # a slice of the excerpts
    extra: tuple[str, ...] = field(default=())


FACTUAL = ("knowledge", "reasoning", "stem_reasoning", "narrative_grounded", "opinion", "how_to", "conversational", "composition")
ROUTES = {
    r.name: r
    for r in (
        Route("knowledge_qa", ("knowledge",), 3, pool="first"),
        Route("reasoning_qa", ("reasoning",), 4, 2),
        Route("stem_reasoning", ("stem_reasoning",), 6, 2, "refurbished", broken_math=True),
        Route("narrative_grounded", ("narrative_grounded",), 3),
        Route("narrative_fiction", ("narrative_fiction",), 3),
        Route("composition_qa", ("composition",), 3, answer="refurbished"),
        Route("how_to_qa", ("how_to",), 4),
        Route("opinion_qa", ("opinion",), 3),
        Route("verse_qa", ("verse",), 2, answer="verse"),
        Route("multiturn_qa", ("knowledge",), 2, answer="turns", pool="second"),
        Route("calibration_qa", FACTUAL, 1, 2, hedge=True),
    )
}


def _may_use(route: Route, floor: float, affordance: str | None, broken: Column, hedged: Column) -> Column:
    ok = F.coalesce(F.arrays_overlap("classes", F.array(*map(F.lit, route.classes))), F.lit(False)) & (F.coalesce("prose_score", F.lit(0.0)) >= floor)
    if affordance:
        ok = ok & (F.col("affordance") == affordance)
    if not route.broken_math:
        ok = ok & ~F.coalesce(broken, F.lit(False))
    if route.hedge:
        ok = ok & F.coalesce(hedged, F.lit(False))
    if route.name == "narrative_fiction":
        ok = ok & ~F.coalesce(F.array_contains("classes", "narrative_grounded"), F.lit(False))
    return ok


def sources(excerpts: DataFrame, route: Route, floor: float = 0.0, affordance: str | None = None) -> DataFrame:
    """The excerpts a route may use. Null classes have none, null scores count 0. Fiction leaves grounded episodes to the other route."""
    c = F.col("excerpt")
    return excerpts.where(_may_use(route, floor, affordance, S.has_broken_math(c), S.has_calibration_hedge(c)))


def routes_of(floor: float = 0.0) -> Column:
    """The names of all routes that may use an excerpt (classes, prose_score, excerpt), told in one reading of it."""
    marks = F.array(F.struct(S.has_broken_math(F.col("excerpt")).alias("broken"), S.has_calibration_hedge(F.col("excerpt")).alias("hedged")))
    names = lambda m: F.filter(F.array(*[F.when(_may_use(r, floor, None, m["broken"], m["hedged"]), F.lit(r.name)) for r in ROUTES.values()]), lambda x: x.isNotNull())
    return F.flatten(F.transform(marks, names))


def checked_answer(route: Route, spans: Column, excerpt: Column) -> Column:
    """The answer that a route's spans make, or null if they fail its check. Refurbished spans are structs (verbatim, refurbished)."""
    if route.answer == "refurbished":
        return N.refurbished_spans(spans, excerpt, route.spans)
    if route.answer == "verse":
        return N.verse_spans(spans, excerpt, route.spans)
    got = N.locate_spans(spans, excerpt, route.spans)
    return F.when(S.has_calibration_hedge(got), got) if route.hedge else got


def output_rows(answered: DataFrame) -> DataFrame:
    """(doc_index, category, book_category, year, question, answer) of rows with both sides; the model's category goes before the book's."""
    q, a = F.trim("question"), F.col("answer")
    return answered.where((F.coalesce(q, F.lit("")) != "") & (F.coalesce(a, F.lit("")) != "")).select(
        "doc_index", F.coalesce(F.nullif(F.trim("model_category"), F.lit("")), F.col("category")).alias("category"), F.col("category").alias("book_category"), "year", q.alias("question"), a.alias("answer")
    )


# ---- verify and grade ------------------------------------------------------------------------------------------


def misaligned(judged: DataFrame, route: str = "route", value: str = "value") -> DataFrame:
    """(route, judged, bad, rate) with a line ``ALL``; unjudged rows (null) count in neither."""
    own = judged.where(F.col(value).isNotNull())
    return own.rollup(route).agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col(value) == 0).alias("bad")).select(F.coalesce(route, F.lit("ALL")).alias(route), "judged", "bad", F.bround(F.try_divide("bad", "judged"), 6).alias("rate"))


def apply_verify(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows without those whose document has any exchange judged 0; unjudged ones stay. ``judged`` (key ``doc#k``, value)."""
    bad = judged.where(F.col("value") == 0).select(F.regexp_replace("key", "#[^#]*$", "").alias("_k")).distinct()
    return rows.join(bad, F.col("doc_index") == F.col("_k"), "left_anti")


def apply_grade(rows: DataFrame, score: Column, names: Column) -> DataFrame:
    """``rows`` with ``score`` (the judge's, at most what its defects allow), ``warnings`` and ``publish``: null scores aren't published."""
    from papyr.operators.stats import warning_cap

    return rows.withColumn("warnings", names).withColumn("score", F.when(score.isNotNull(), F.least(score, warning_cap(F.col("warnings"))))).withColumn("publish", F.col("score").isNotNull())
