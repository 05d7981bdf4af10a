"""Per-record text statistics, and records in the tails of their distributions.

Statistics are computed for each text; their distributions by language are kept as mergeable KLL sketches,
built by partial aggregation over all rows. Quartiles from the sketches turn each value into a
robust z-score and ranks from them into a percentile. Text that is no prose lies far out in the lower tails of
sentence length, linking words and known words.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyr.llm.defects import guess
from papyr.llm.tokens import LONG, names
from papyr.session import materialise

COMMON_WORDS = 150  # of each language, by the number of texts that hold them
KNOWN_WORDS = 60_000  # most frequent words, of which those above KNOWN_SHARE of all are known
KNOWN_SHARE = 1e-5
SKETCH_K = 400  # size parameter of the quantile sketches

# Words that stand inside of noun phrases, which lists and tables use as well.
NOUN_PHRASE = frozenset("of the and a an or de la le les des du et un une d l der die das des dem den und ein eine el los las y del una di il dei della delle e lo gli".split())

STATISTICS = ("word_count", "characters", "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_share", "common_share", "link_share", "link_kinds", "known_share", "unit_words", "sentence_words")

_WORDS = re.compile(r"[^\W\d_]{2,}")
_LINE = re.compile(r"\n(?![a-zà-ÿ])")
_FIGURES = re.compile(r"[\d£]+")
# ends of units: of sentences and their parts, columns, items; figures are no words
_UNIT = re.compile(r"[.!?…;:,|│·•/=—–\t\x1f*+()\[\]{}<>]+(?:\s*-\s)?|  +")
_SENTENCE = re.compile(r"[.!?…]+|\n\n")


def _counts(pieces: list[str]) -> list[int]:
    """The words of each piece that has any: blanks between them, and one."""
    return [x.count(" ") + x.count("\n") + 1 for x in map(str.strip, pieces) if x]


def units(text: str) -> list[int]:
    """The words in each unit: a stretch without stop, column or item sign; a line is a unit unless the next one begins in lower case."""
    return _counts(_UNIT.split(_FIGURES.sub("", _LINE.sub("\x1f", text))))


@dataclass(frozen=True)
class Vocabulary:
    common: frozenset[str]
    links: frozenset[str]  # common words that don't stand in noun phrases
    known: frozenset[str]


def statistics(text: str, v: Vocabulary) -> tuple[str, list[float]]:
    """(language or ``other``, values of STATISTICS) of a text that isn't blank."""
    low = text.lower()
    words = _WORDS.findall(low)
    every = text.split()
    tokens, dense = len(every), sum(map(len, every))
    n = len(words)
    kinds = set(words)
    letters = sum(map(len, words))
    if any(len(w) > LONG for w in kinds):
        words = names(words)
        kinds = set(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pieces = units(text)
    sentences = _counts(_SENTENCE.split(text))
    links = v.links & kinds
    n_links = sum(map(links.__contains__, words)) if links else 0
    digits = sum(map(text.count, "0123456789"))
    share = lambda x, y: x / y if y else 0.0
    values = [
        float(tokens),
        float(dense),
        share(letters, n),
        share(dense - letters - digits, dense),
        share(digits, dense),
        share(sum(x.rstrip(" \t\r\"'”’»)]")[-1:] in ".!?…" for x in lines), len(lines)),
        share(sum(map(v.common.__contains__, words)), max(tokens, n)),
        share(n_links, n),
        share(len(links), max(n, 12) ** 0.5),
        share(sum(map(v.known.__contains__, words)), max(tokens, n)),
        # words in units, each unit weighed by its words, so that a few short ones don't matter
        share(sum(u * u for u in pieces), sum(pieces)),
        share(sum(u * u for u in sentences), sum(sentences)),
    ]
    return guess(kinds) or "other", values


def count_words(texts: DataFrame) -> DataFrame:
    """(word, lang, texts, n): in how many texts of a language a word stands, and how often, over all rows."""

    def run(batches):
        for b in batches:
            df: dict[str, Counter] = {}
            tf: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    words = names(_WORDS.findall(t.lower()))
                    kinds = set(words)
                    k = guess(kinds) or "other"
                    df.setdefault(k, Counter()).update(kinds)
                    tf.update(words)
            keys = [(w, k) for k, own in df.items() for w in own]
            seen: set[str] = set()
            first = [tf[w] if not (w in seen or seen.add(w)) else 0 for w, _ in keys]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([df[k][w] for w, k in keys], pa.int64()), pa.array(first, pa.int64())], names=["word", "lang", "texts", "n"])

    return texts.select("text").mapInArrow(run, "word string, lang string, texts bigint, n bigint").groupBy("word", "lang").agg(F.sum("texts").alias("texts"), F.sum("n").alias("n"))


def learn(texts: DataFrame) -> Vocabulary:
    """Common and known words of a corpus: bounded lists, from counts over all of it."""
    counted = materialise(count_words(texts), "words")
    top = counted.where(F.col("lang") != "other").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("texts").desc(), "word"))).where(F.col("r") <= COMMON_WORDS)
    common = frozenset(r["word"] for r in top.select("word").collect())
    every = counted.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, KNOWN_SHARE * every)).orderBy(F.col("n").desc(), "word").limit(KNOWN_WORDS).collect()
    return Vocabulary(common, common - NOUN_PHRASE, frozenset(r["word"] for r in rows))


def measure(texts: DataFrame, v: Vocabulary, keep: list[str]) -> DataFrame:
    """(keep..., lang, the STATISTICS) of each text; null, empty and blank texts have lang and statistics null."""
    shipped = texts.sparkSession.sparkContext.broadcast(v)
    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        vocabulary = shipped.value
        for b in batches:
            rows = [statistics(t, vocabulary) if t and not t.isspace() else None for t in b.column(len(keep)).to_pylist()]
            cols = [pa.array([r[0] if r else None for r in rows], pa.string())]
            cols += [pa.array([r[1][j] if r else None for r in rows], pa.float64()) for j in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], *cols], names=[*keep, "lang", *STATISTICS])

    return texts.select(*keep, F.col("text").cast("string")).mapInArrow(run, f"{schema}, lang string, " + ", ".join(f"{s} double" for s in STATISTICS))


def sketches(measured: DataFrame) -> DataFrame:
    """A row per language with a KLL sketch (binary) of each statistic; ``all`` merges those of the languages, ``other`` are texts of none."""
    aggs = [F.kll_sketch_agg_double(s, SKETCH_K).alias(s) for s in STATISTICS]
    some = measured.where(F.col("lang").isNotNull())
    own = some.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), *aggs)
    every = own.where(F.col("lang") != "other").agg(F.lit("all").alias("lang"), F.sum("texts").alias("texts"), *[F.kll_merge_agg_double(s).alias(s) for s in STATISTICS])
    return own.unionByName(every)


# the quantiles that are read from a sketch: dense in the tails, where records are told apart
GRID = (0.001, 0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.04, *(i / 20 for i in range(1, 20)), 0.96, 0.97, 0.98, 0.985, 0.99, 0.995, 0.998, 0.999)


def quantiles(sketched: DataFrame) -> list[dict]:
    """The quantiles of GRID of each statistic by language: a few numbers for each of the seven groups."""
    cols = [F.kll_sketch_get_quantile_double(F.col(s), F.array(*map(F.lit, GRID))).alias(s) for s in STATISTICS]
    return [r.asDict() for r in sketched.where(F.col("texts") > 0).select("lang", "texts", *cols).collect()]


OWN_TEXTS = 50.0  # of a language at which its own distributions count as much as those of all texts
# The statistics whose lower tails tell text that is no prose, with the least sigma where texts are very alike.
TAILS = {"unit_words": 1.8, "link_kinds": 0.5, "link_share": 0.06, "known_share": 0.09, "common_share": 0.1}
SHORT = 12.0  # words at which a value is taken for twice as uncertain
FRAGMENTED = -1.9  # z of unit_words from which a text is a list or table: nothing but short units
UNKNOWN, UNLINKED = -4.0, -3.0  # z of known_share and link_share from which it is junk: no words of a language


def _at(q: list[float], level: float) -> float:
    return q[GRID.index(level)]


def _percentile(value: F.Column, q: F.Column) -> F.Column:
    """A value's percentile among quantiles of GRID (an array): halfway within the step it falls into, the first and last steps included."""
    levels = F.array(*[F.lit(100.0 * b) for b in (0.0, *GRID, 1.0)])
    below, upto = F.size(F.filter(q, lambda x: x < value)), F.size(F.filter(q, lambda x: x <= value))
    # a value that equals several quantiles lies in the middle of them
    return (F.element_at(levels, below + 1) + F.element_at(levels, upto + 2)) / 2


def score(measured: DataFrame, groups: list[dict]) -> DataFrame:
    """``measured`` with z-scores (``z_`` and the statistic), percentiles (``pct_``) and ``is_prose``.

    z = (value - median) / (robust sigma from the quartiles), less for texts of few words; percentiles are read off the
    quantiles of GRID. Medians, sigmas and percentiles are those of the text's language drawn towards those of all texts:
    with n texts the language's own weigh n / (n + OWN_TEXTS), so none changes at a stroke. Texts of no
    language are held against all texts of languages. Blank texts have null scores.
    """
    held = {g["lang"]: g for g in groups if g["lang"] not in ("other", "all")}
    base = next((g for g in groups if g["lang"] == "all"), None) or next(iter(groups), None)
    if base is None:
        return measured.select("*", *[F.lit(None).cast("double").alias(f"{p}_{s}") for s in TAILS for p in ("z", "pct")], F.lit(None).cast("boolean").alias("is_prose"))
    size = F.sqrt(1 + SHORT / F.greatest(F.col("characters") / 6, F.lit(1.0)))
    out = measured
    for s, floor in TAILS.items():

        def numbers(g: dict, s: str = s, floor: float = floor) -> tuple[float, float]:
            q = [float(x) for x in g[s]]
            return _at(q, 0.5), max((_at(q, 0.75) - _at(q, 0.25)) / 1.349, floor)

        med0, sig0 = numbers(base)
        array = lambda g, s=s: F.array(*[F.lit(float(x)) for x in g[s]])
        med, sig, weight, grid = F.lit(med0), F.lit(sig0), F.lit(0.0), array(base)
        for k, g in held.items():
            own = F.col("lang") == k
            share = g["texts"] / (g["texts"] + OWN_TEXTS)
            m, d = numbers(g)
            med, sig = F.when(own, share * m + (1 - share) * med0).otherwise(med), F.when(own, share * d + (1 - share) * sig0).otherwise(sig)
            weight, grid = F.when(own, share).otherwise(weight), F.when(own, array(g)).otherwise(grid)
        pct = weight * _percentile(F.col(s), grid) + (1 - weight) * _percentile(F.col(s), array(base))
        out = out.withColumns({f"z_{s}": (F.col(s) - med) / (sig * size), f"pct_{s}": F.when(F.col(s).isNotNull(), pct)})
    no_prose = (F.col("z_unit_words") <= FRAGMENTED) | ((F.col("z_known_share") <= UNKNOWN) & (F.col("z_link_share") <= UNLINKED))
    return out.withColumn("is_prose", F.when(F.col("lang").isNotNull(), ~no_prose))


FITS = 0.5  # of a given prose score, from which it says prose


def judge_given(scored: DataFrame, given: str) -> DataFrame:
    """``scored`` with ``given_fits``: whether a score that came with the record (column ``given``, 0 to 1) says the same as the statistics; null where there is none, it is out of range, or the text is blank."""
    value = F.col(given).cast("double")
    return scored.withColumn("given_fits", F.when((value >= 0) & (value <= 1) & ~F.isnan(value), (value >= FITS) == F.col("is_prose")))


def analyse(texts: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(scored texts, sketches by language) of ``texts`` with a column ``text``.

    One row in, one row out. Null, empty and blank texts have null statistics and ``is_prose`` null.
    Texts are read whole. The statistics, a few numbers a row, are written once and read for
    sketches and scores.
    """
    v = learn(texts)
    measured = materialise(measure(texts, v, keep), "statistics")
    sketched = materialise(sketches(measured), "sketches")
    return score(measured, quantiles(sketched)), sketched
