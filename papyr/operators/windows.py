"""Cutting excerpts out of documents.

One frame for all kinds: a document becomes units (sentences, or lines of verse), candidates are stretches
of units from certain starts, each passes the gates, and a fold keeps the best ones that don't overlap. It is all
native array work in one row; no document leaves its task, and none is exploded and shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyr.functions import signals as S


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row.

    A projection may be inlined into the lambdas that use it, which would compute it for every element of an
    array; a generator of one row is no projection and stays where it is.
    """
    return df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_pin")).select("*", *[F.col(f"_pin.{n}").alias(n) for n in columns]).drop("_pin")


def prefix_sums(sizes: Column) -> Column:
    """0 and the running sums of an array of numbers."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(sizes, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def greedy_disjoint(cands: Column, k: int) -> Column:
    """Of candidates (score, a, b, ...), best first and earlier first on ties, those that overlap none kept before; at most ``k``."""
    ranked = F.array_sort(cands, lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).when(x["a"] < y["a"], -1).when(x["a"] > y["a"], 1).otherwise(0))
    free = lambda kept, c: ~F.exists(kept, lambda u: (c["a"] < u["b"]) & (c["b"] > u["a"]))
    return F.aggregate(ranked, F.slice(ranked, F.lit(1), F.lit(0)), lambda kept, c: F.when((F.size(kept) < k) & free(kept, c), F.concat(kept, F.array(c))).otherwise(kept))


def _spans(doc: DataFrame, starts: Column, length: Column) -> DataFrame:
    """``doc`` (_units, _sums) with candidate spans (a, b): from each start, units until ``length`` words are reached."""

    def one(a: Column) -> Column:
        goal = F.element_at(F.col("_sums"), a + 1) + length
        end = F.size(F.filter(F.col("_sums"), lambda s: s < goal))
        return F.struct(a.alias("a"), F.least(end, F.size("_units")).cast("int").alias("b"))

    return pinned(doc, _spans=F.transform(starts, one))


def _sentence_units(docs: DataFrame, text: str) -> DataFrame:
    got = pinned(docs, _units=S.sentences(S.strip_lines(F.col(text))))
    # units are collapsed, so every blank ends a word
    sizes = F.transform("_units", lambda s: (F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit(""))) + 1).cast("long"))
    lo = F.least(F.floor(F.size("_units") / 10), F.size("_units") - 1).cast("int")
    return pinned(got.where(F.size("_units") > 0), _sums=prefix_sums(sizes), _lo=lo)


def _joined(a: Column, b: Column, sep: str = " ") -> Column:
    return F.array_join(F.slice(F.col("_units"), a + 1, b - a), sep)


def _pick(cut: DataFrame, keep: list[str], gate: Callable[[Column], Column], score: Callable[[Column], Column], k: int, sep: str = " ", places: int = 3) -> DataFrame:
    cands = F.transform("_spans", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), _joined(s["a"], s["b"], sep).alias("text")))
    scored = F.transform(F.filter(cands, lambda c: gate(c["text"])), lambda c: F.struct(score(c["text"]).cast("double").alias("score"), c["a"].alias("a"), c["b"].alias("b"), c["text"].alias("text")))
    cut = pinned(cut, _cands=F.filter(scored, lambda c: c["score"].isNotNull()))
    best = greedy_disjoint(F.col("_cands"), k)
    return cut.select(*keep, F.posexplode(best).alias("n", "w")).select(*keep, "n", F.col("w.a").alias("first"), F.col("w.b").alias("last"), F.bround("w.score", places).alias("score"), F.col("w.text").alias("excerpt"))


def _usable(c: Column) -> Column:
    return S.is_self_contained(c) & S.has_affordance(c) & ~S.is_garbage(c)


def stem_windows(docs: DataFrame, keep: list[str], text: str = "text", words: int = 170, k: int = 4, floor: float = 0.3) -> DataFrame:
    """(keep..., n, first, last, score, excerpt): windows around sentences with a reasoning connective, the highest signal first.

    From the sentence before each of the first 300 such sentences past the document's first tenth.
    """
    d = _sentence_units(docs, text)
    at = F.filter(F.transform("_units", lambda s, i: F.when((i >= F.col("_lo")) & S.has(s, S.CONNECTIVE), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.transform(F.slice(at, F.lit(1), F.lit(300)), lambda i: F.greatest(F.col("_lo"), i - 1)))
    return _pick(_spans(d, starts, F.lit(words)), keep, lambda c: _usable(c) & (S.region_quality(c) >= 0.5), lambda c: F.when(S.stem_signal(c) >= floor, S.stem_signal(c)), k)


def stem_excerpt(docs: DataFrame, keep: list[str], text: str = "text", words: int = 150, anchors: int = 200) -> DataFrame:
    """(keep..., score, affordance, excerpt): of a document's windows around its first ``anchors`` sentences with a reasoning connective the one of highest signal; none where no window has any."""
    d = _sentence_units(docs, text)
    at = F.filter(F.transform("_units", lambda s, i: F.when((i >= F.col("_lo")) & S.has(s, S.CONNECTIVE), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.transform(F.slice(at, F.lit(1), F.lit(anchors)), lambda i: F.greatest(F.col("_lo"), i - 1)))
    best = _pick(_spans(d, starts, F.lit(words)), keep, lambda c: _usable(c) & (S.region_quality(c) >= 0.5), lambda c: F.when(S.stem_signal(c) > 0, S.stem_signal(c)), 1)
    return best.select(*keep, "score", F.lit("stem_reasoning").alias("affordance"), "excerpt")


def conversational_windows(docs: DataFrame, keep: list[str], text: str = "text", words: int = 220, k: int = 3, floor: float = 0.35) -> DataFrame:
    """Windows of lessons in question and answer, from the sentence before each of the first 300 questions or marks."""
    d = _sentence_units(docs, text)
    at = F.filter(F.transform("_units", lambda s, i: F.when((i >= F.col("_lo")) & (F.contains(s, F.lit("?")) | S.has(s, S.QA_MARK)), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.transform(F.slice(at, F.lit(1), F.lit(300)), lambda i: F.greatest(F.col("_lo"), i - 1)))
    return _pick(_spans(d, starts, F.lit(words)), keep, lambda c: _usable(c) & S.is_structured_dialogue(c), lambda c: F.when(S.conversational_signal(c) >= floor, S.conversational_signal(c)), k)


def verse_windows(docs: DataFrame, keep: list[str], text: str = "text", lines: int = 12, k: int = 6, floor: float = 0.6) -> DataFrame:
    """Windows of ``lines`` non-blank lines, every third past the first tenth, most of which are short and open on a capital. Line breaks stay."""
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    d = pinned(docs, _units=F.filter(trimmed, lambda x: x != "")).where(F.size("_units") >= lines)
    lo = F.floor(F.size("_units") / 10).cast("int")
    spans = F.transform(F.sequence(lo, F.greatest(lo, F.size("_units") - lines), F.lit(3)), lambda i: F.struct(i.alias("a"), (i + lines).alias("b")))
    d = pinned(d, _spans=F.filter(spans, lambda s: s["b"] <= F.size("_units")))
    share = lambda c: F.size(F.filter(F.split(c, "\n"), lambda x: (F.length(x) <= 55) & S.has(x, r"^\p{Lu}"))) / lines
    return _pick(d, keep, lambda c: (share(c) >= floor) & (S.word_count(c) >= 20) & ~S.is_garbage(c), share, k, "\n")


def draw(key: Column, purpose: str, n: Column | None = None, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on key, purpose, counter and seed alone: the same under any partitioning, and in SQL."""
    parts = [F.lit(f"{seed}:{purpose}:"), key.cast("string")] + ([F.lit(":"), n.cast("string")] if n is not None else [])
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("double") / 4294967296.0


# Fixed pattern: [^A-Za-z ]+, which takes the JVM twenty times as long when written so.
NO_LETTER = r"[\x00-\x1F!-@\[-`{-\x{10FFFF}]+"


def _tallies(d: DataFrame) -> DataFrame:
    """``d`` (_units) with _tallies: 0 and the running sums of what :func:`papyr.functions.signals.region_quality` counts.

    Units are collapsed and joined by blanks, which no counted thing spans, so a window's counts are differences of these.
    """
    fields = ("solid", "letters", "figures", "words", "stop")
    unspaced = lambda c: F.replace(c, F.lit(" "), F.lit(""))

    # for ASCII, whose letters and figures are few, cheaper counts
    def seen(s: Column) -> Column:
        return F.struct(s.alias("s"), F.length(unspaced(s)).alias("solid"), (F.octet_length(s) == F.length(s)).alias("ascii"), F.lower(F.regexp_replace(s, NO_LETTER, " ")).alias("words"))

    def split(x: Column) -> Column:
        letters = F.when(x["ascii"], F.octet_length(unspaced(x["words"]))).otherwise(F.length(F.regexp_replace(x["s"], r"\P{L}+", "")))
        figures = F.when(x["ascii"] & ~S.has(x["s"], "[0-9]"), 0).otherwise(S.count(x["s"], S.FIGURE))
        return F.struct(x["solid"].alias("solid"), letters.alias("letters"), figures.alias("figures"), F.array_remove(F.split(x["words"], " "), F.lit("")).alias("words"))

    def tally(x: Column) -> Column:
        sums = (x["solid"], x["letters"], x["figures"], F.size(x["words"]), F.size(F.filter(x["words"], lambda w: w.isin(S.STOP_WORDS))))
        return F.struct(*[c.cast("long").alias(n) for n, c in zip(fields, sums, strict=True)])

    zero = F.array(F.struct(*[F.lit(0).cast("long").alias(n) for n in fields]))
    add = lambda acc, x: F.concat(acc, F.transform(F.slice(acc, -1, 1), lambda y: F.struct(*[(y[n] + x[n]).alias(n) for n in fields])))
    return pinned(pinned(d, _tally=F.transform(F.transform(F.transform("_units", seen), split), tally)), _tallies=F.aggregate("_tally", zero, add)).drop("_tally")


def _tallied_quality(a: Column, b: Column) -> Column:
    """The region quality of units ``a`` to ``b``, the same number as of their text."""
    lo, hi = F.element_at(F.col("_tallies"), a + 1), F.element_at(F.col("_tallies"), b + 1)
    counts = F.struct(*[(hi[n] - lo[n]).alias(n) for n in ("solid", "letters", "figures", "words", "stop")], (F.element_at(F.col("_sums"), b + 1) - F.element_at(F.col("_sums"), a + 1)).alias("tokens"))
    return _once(counts, lambda x: S.quality_of(x["solid"], x["letters"], x["figures"], x["words"], x["stop"], x["tokens"] / (b - a)))


def prose_windows(docs: DataFrame, key: str, keep: list[str], text: str = "text", k: int = 3, floor: float = 0.7, tries: int = 10, words: int | None = None, seed: int = 0) -> DataFrame:
    """Up to ``k`` windows of running prose from seeded starts; in the order of the draws, the first that pass the gates and overlap none before.

    Lengths fall in bands: 40 percent 120-180 words, 35 percent 300-450, the rest 550-800. What would be rejected anyway is
    neither drawn nor judged: windows drawn before, those that overlap a kept one, and all when no gap between kept ones
    holds the least length or reaches the text's end.
    """
    d = _tallies(_sentence_units(docs, text))
    u = lambda purpose, t: draw(F.col(key), purpose, t, seed)
    least, sums, n_units = words or 120, F.col("_sums"), F.size("_units")

    def start(t: Column) -> Column:
        return F.struct(t.alias("t"), (F.col("_lo") + F.floor(u("start", t) * (n_units - F.col("_lo")))).cast("int").alias("a"))

    def end(x: Column) -> Column:
        band, within, a = u("band", x["t"]), u("words", x["t"]), x["a"]
        n = F.lit(words) if words else F.when(band < 0.40, 120 + F.floor(within * 61)).when(band < 0.75, 300 + F.floor(within * 151)).otherwise(550 + F.floor(within * 251))
        from_a = F.element_at(sums, a + 1)
        # a unit has a word at least, so no more than n units are needed
        reached = _once(n.cast("int"), lambda n: a + F.size(F.filter(F.slice(sums, a + 1, n + 1), lambda s: s < from_a + n)))
        return F.struct(a.alias("a"), F.when(F.element_at(sums, -1) - from_a <= least, n_units).otherwise(F.least(reached, n_units)).cast("int").alias("b"))

    def room(kept: Column) -> Column:
        gap = lambda p: F.array_min(F.transform(F.filter(kept, lambda w: w["a"] >= p), lambda w: F.element_at(sums, w["a"] + 1))) - F.element_at(sums, p + 1)
        return F.exists(F.concat(F.array("_lo"), F.transform(kept, lambda w: w["b"])), lambda p: (p < n_units) & (F.coalesce(gap(p), F.lit(least)) >= least))

    code = lambda s: s["a"].cast("long") * 2**32 + s["b"]
    free = lambda kept, s: ~F.exists(kept, lambda w: (s["a"] < w["b"]) & (s["b"] > w["a"]))

    def judged(acc: Column, s: Column) -> Column:
        opens = F.filter(F.array(s), lambda x: S.is_self_contained(F.element_at(F.col("_units"), x["a"] + 1)))
        rated = F.transform(opens, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), _tallied_quality(x["a"], x["b"]).alias("score")))
        passed = F.filter(rated, lambda x: (x["score"] >= floor) & F.exists(F.array(_joined(x["a"], x["b"])), lambda c: S.has_affordance(c) & ~S.is_garbage(c)))
        return F.struct(passed.alias("new"), F.concat(acc["seen"], F.array(code(s))).alias("seen"))

    def tried(acc: Column, t: Column) -> Column:
        fresh = F.filter(F.transform(F.array(start(t)), end), lambda s: ~F.array_contains(acc["seen"], code(s)) & free(acc["kept"], s))
        results = F.transform(fresh, lambda s: judged(acc, s))
        added = lambda r: _once(F.concat(acc["kept"], r["new"]), lambda kept: F.struct(kept.alias("kept"), r["seen"].alias("seen"), F.when(F.size(r["new"]) == 0, True).otherwise((F.size(kept) < k) & room(kept)).alias("room")))
        return F.coalesce(F.get(F.transform(results, added), F.lit(0)), acc)

    zero = F.struct(F.array().cast("array<struct<a:int,b:int,score:double>>").alias("kept"), F.array().cast("array<bigint>").alias("seen"), F.lit(k > 0).alias("room"))
    best = F.aggregate(F.sequence(F.lit(1), F.lit(k * tries)), zero, lambda acc, t: F.when(acc["room"], tried(acc, t)).otherwise(acc), lambda acc: acc["kept"])
    best = pinned(d, _best=best).select(*keep, "_units", "_sums", F.posexplode("_best").alias("n", "w"))
    best = pinned(best, _text=_joined(F.col("w.a"), F.col("w.b")), _words=F.element_at(sums, F.col("w.b") + 1) - F.element_at(sums, F.col("w.a") + 1))
    return _labelled(best).select(*keep, "n", F.col("w.a").alias("first"), F.col("w.b").alias("last"), F.bround("w.score", 3).alias("score"), F.col("_label").alias("affordance"), F.col("_text").alias("excerpt"))


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a column that is computed once, wherever and however often ``use`` has it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _labelled(d: DataFrame) -> DataFrame:
    """``d`` (_text, _words) with _label, the affordance label of the text."""
    c = F.col("_text")
    d = pinned(d, _low=F.when((F.octet_length(c) == F.length(c)) | ~S.has(c, S.NOT_PLAIN), F.lower(c)))
    d = pinned(d, _past=S.count(F.when(F.col("_low").isNotNull(), c), S.plain(S.PAST)), _speech=S.count(F.col("_low"), S.plain(S.SPEECH)))
    low = S.affordance_label(F.col("_low"), S.plain, F.col("_words"), F.col("_past"), F.col("_speech"))
    return d.withColumn("_label", F.when(F.col("_low").isNotNull(), low).otherwise(S.affordance_label(c)))


def prose_excerpt(docs: DataFrame, key: str, keep: list[str], text: str = "text", words: int = 150, floor: float = 0.7, tries: int = 16, seed: int = 0) -> DataFrame:
    """One window a document: of the seeded tries the first at the floor, else the best."""
    d = _sentence_units(docs, text)

    def span(t: Column) -> Column:
        a = (F.col("_lo") + F.floor(draw(F.col(key), "excerpt", t, seed) * (F.size("_units") - F.col("_lo")))).cast("int")
        goal = F.element_at(F.col("_sums"), a + 1) + words
        return F.struct(a.alias("a"), F.least(F.size(F.filter(F.col("_sums"), lambda s: s < goal)), F.size("_units")).cast("int").alias("b"), t.alias("t"))

    d = pinned(d, _spans=F.transform(F.sequence(F.lit(1), F.lit(tries)), span))
    cands = F.filter(F.transform("_spans", lambda s: F.struct(s["t"].alias("t"), _joined(s["a"], s["b"]).alias("text"))), lambda c: _usable(c["text"]))
    rated = F.transform(cands, lambda c: F.struct(S.region_quality(c["text"]).alias("score"), c["t"].alias("t"), c["text"].alias("text")))
    rank = lambda c: F.when(c["score"] >= floor, 2.0).otherwise(c["score"])
    best = F.array_sort(rated, lambda x, y: F.when(rank(x) > rank(y), -1).when(rank(x) < rank(y), 1).when(x["t"] < y["t"], -1).otherwise(1))
    return pinned(d, _b=F.get(best, F.lit(0))).where(F.col("_b").isNotNull()).select(*keep, F.bround("_b.score", 3).alias("score"), S.affordance_label(F.col("_b.text")).alias("affordance"), F.col("_b.text").alias("excerpt"))


# Fixed pattern: phrases near which a text may leave a point open.
ANCHOR = (
    r"(?iU)\b(?:not known|unknown|cannot be known|cannot be determined|cannot be ascertained|cannot say|no one knows|little is known|remains obscure|not settled|unsettled|"
    r"in dispute|matter of (?:conjecture|dispute|doubt)|authorities (?:differ|are divided)|opinions (?:differ|are divided)|no record|no account|record is lost|account is lost|"
    r"date is lost|year is lost|name is lost|not recorded|never recorded|no means of|impossible to (?:say|determine|ascertain)|difficult to (?:say|determine)|"
    r"not easy to (?:say|determine)|idle to (?:conjecture|speculate)|refrain from (?:conjecture|speculation)|cannot safely be affirmed|beyond .*?knowledge)\b"
)


def calibration_windows(docs: DataFrame, key: str, keep: list[str], text: str = "text", k: int = 8, words: int = 260, floor: float = 0.70, seed: int = 0) -> DataFrame:
    """Neighbourhoods of sentences that leave a point of fact open: two sentences on either side, back while the opening dangles, one on either side if too long; in seeded order."""
    d = _sentence_units(docs, text)
    at = F.filter(F.transform("_units", lambda s, i: F.when((i >= F.col("_lo")) & S.has(s, ANCHOR) & S.has_calibration_hedge(s), i)), lambda i: i.isNotNull())
    n = F.size("_units")

    def span(i: Column) -> Column:
        two = F.greatest(F.col("_lo"), i - 2)
        back = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda x: F.greatest(F.col("_lo"), two - x))
        a = F.coalesce(F.get(F.filter(back, lambda x: S.is_self_contained(F.element_at(F.col("_units"), x + 1))), F.lit(0)), F.element_at(back, -1))
        b = F.least(n, i + 3)
        size = F.element_at(F.col("_sums"), b + 1) - F.element_at(F.col("_sums"), a + 1)
        wide = size > words
        return F.struct(F.when(wide, F.greatest(F.col("_lo"), i - 1)).otherwise(a).cast("int").alias("a"), F.when(wide, F.least(n, i + 2)).otherwise(b).cast("int").alias("b"), draw(F.col(key), "anchor", i, seed).alias("u"))

    d = pinned(d, _spans=F.transform(at, span))
    cands = F.transform("_spans", lambda s: F.struct((-s["u"]).alias("score"), s["a"].alias("a"), s["b"].alias("b"), _joined(s["a"], s["b"]).alias("text")))
    passed = F.filter(cands, lambda c: _usable(c["text"]) & (S.region_quality(c["text"]) >= floor) & S.has_calibration_hedge(c["text"]))
    d = pinned(d, _cands=passed)
    best = greedy_disjoint(F.col("_cands"), k)
    return d.select(*keep, F.posexplode(best).alias("n", "w")).select(*keep, "n", F.col("w.a").alias("first"), F.col("w.b").alias("last"), F.bround(S.region_quality(F.col("w.text")), 3).alias("score"), F.col("w.text").alias("excerpt"))


def fragment(sentence: Column, key: Column, seed: int = 0) -> Column:
    """A sentence broken off after a seeded number of words, 2 to 9 and two short of its end, without a trailing mark; null if too short."""
    w = S.tokens(sentence)
    top = F.least(F.size(w) - 2, F.lit(9))
    n = (2 + F.floor(draw(key, "fragment", None, seed) * (top - 1))).cast("int")
    return F.when(top >= 2, F.regexp_replace(F.array_join(F.slice(w, F.lit(1), n), " "), "[,;:]+$", ""))
