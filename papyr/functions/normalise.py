"""Character normalisation and checks of spans and model replies, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyr.functions.signals import collapse, count, has

# Characters and what stands for them.
CHARACTERS = {
    "—": "--", "―": "--", "–": "-", "‒": "-", "−": "-", "“": '"', "”": '"', "„": '"', "‟": '"', "‘": "'", "’": "'", "‚": "'", "‛": "'", "′": "'", "″": '"', "…": "...", "\u00a0": " ",
    "ſ": "s", "æ": "ae", "Æ": "Ae", "œ": "oe", "Œ": "Oe", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "¹": "1", "²": "2", "³": "3", "⁰": "0", "⁴": "4", "⁵": "5", "⁶": "6", "⁷": "7", "⁸": "8", "⁹": "9",
    "₀": "0", "₁": "1", "₂": "2", "₃": "3", "₄": "4", "₅": "5", "₆": "6", "₇": "7", "₈": "8", "₉": "9",
    "½": "1/2", "¼": "1/4", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅕": "1/5", "⅘": "4/5", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8", "⁄": "/",
}
# Greek and Cyrillic letters that look like Latin ones.
CONFUSABLE = {
    "ο": "o", "ν": "v", "α": "a", "ρ": "p", "τ": "t", "ι": "i", "κ": "k", "χ": "x", "ε": "e", "υ": "u", "А": "A", "О": "O", "Е": "E", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "М": "M", "Н": "H", "К": "K", "В": "B", "а": "a", "о": "o", "е": "e", "р": "p", "с": "c", "х": "x", "у": "y", "и": "u",
}
# Fixed pattern: UTF-8 that was read in another encoding.
MOJIBAKE = "Ã[\\x{80}-\\x{BF}©®¨«»]|â€[\\x{99}\\x{9C}\\x{9D}\\x{93}\\x{94}]|Â[\\x{A0}-\\x{BF}]|\\x{FFFD}"
# Fixed pattern: control and format characters that go.
UNSEEN = r"[\p{Cc}\p{Cf}&&[^\n\t]]"


def strip_controls(c: Column) -> Column:
    """The text without control and format characters; line breaks and tabs stay."""
    return F.regexp_replace(c, UNSEEN, "")


def map_characters(c: Column) -> Column:
    """Typographic signs, joined letters, raised figures and fractions in plain characters."""
    single = {k: v for k, v in CHARACTERS.items() if len(v) == 1}
    out = F.translate(c, "".join(single), "".join(single.values()))
    for k, v in CHARACTERS.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def mapped_count(c: Column) -> Column:
    return count(c, "[" + "".join(CHARACTERS) + "]")


def mojibake_count(c: Column) -> Column:
    return count(c, MOJIBAKE)


_SCRIPTS = {"Greek": r"\p{IsGreek}", "Cyrillic": r"\p{IsCyrillic}", "Hebrew": r"\p{IsHebrew}", "Arabic": r"\p{IsArabic}", "Devanagari": r"\p{IsDevanagari}"}


def _polluted(w: Column) -> Column:
    """Whether a word is mostly Latin with letters of one other script that all look like Latin ones."""
    latin = count(w, r"[\p{IsLatin}&&\p{L}]")
    letters = count(w, r"\p{L}")
    foreign = letters - latin
    one = sum((F.when(count(w, s) > 0, 1).otherwise(0) for s in (r"[\p{IsGreek}&&\p{L}]", r"[\p{IsCyrillic}&&\p{L}]")), F.lit(0)) == 1
    known = count(w, "[" + "".join(CONFUSABLE) + "]")
    return (latin > foreign) & (foreign > 0) & one & (known == foreign)


def fix_confusables(c: Column) -> Column:
    """Look-alike letters inside Latin words replaced; words of another script stay. Words are cut at single blanks."""
    table = "".join(CONFUSABLE), "".join(CONFUSABLE.values())
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.when(_polluted(w), F.translate(w, *table)).otherwise(w)), " ")


def confusable_words(c: Column) -> Column:
    """The polluted words of a text, cut at any white space."""
    return F.filter(F.split(c, r"(?U)\s+"), _polluted)


def normalise(c: Column) -> Column:
    return fix_confusables(map_characters(strip_controls(c)))


def normalise_turns(turns: Column) -> Column:
    """Each turn's content normalised; its other fields stay."""
    return F.transform(turns, lambda t: t.withField("content", normalise(t["content"])))


def ends_mid_word(c: Column) -> Column:
    """Whether a text breaks off in a hyphenated word, which nothing can restore."""
    return has(F.rtrim(F.regexp_replace(c, r"(?U)\s+$", "")), "[A-Za-z]{2,}-$")


def letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))


# Words without content of their own.
CONTENT_STOP = (
    "a an the is are was were be been of to in on for and or but what which who how why does do did it its this that these those with by from as at not no yes so if when "
    "where their they them there we you he she his her"
).split()


def content_set(c: Column) -> Column:
    """The distinct words of three letters or more that carry content."""
    return F.array_distinct(F.filter(word_tokens(c), lambda w: (F.length(w) > 2) & ~w.isin(CONTENT_STOP)))


def echo(q: Column, a: Column) -> Column:
    """Share of a question's content words that its answer holds; 0 without any."""
    x = content_set(q)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, content_set(a))), F.size(x)), F.lit(0.0))


def jaccard(x: Column, y: Column) -> Column:
    a, b = content_set(x), content_set(y)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def is_template(q: Column) -> Column:
    return has(F.lower(q), r"(?U)^\s*what\s+(is|are)\b")


# ---- spans ---------------------------------------------------------------------------------------


def _capitalised(c: Column) -> Column:
    return F.when(c != "", F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1_000_000_000)))


def _locate(span: Column, text: Column) -> Column:
    """The text's own words of a span, ignoring case, and if need be the span's final marks; null if it isn't there."""
    low = F.lower(text)
    s = collapse(span)
    bare = F.regexp_replace(s, "[.,;:\"']+$", "")
    at, again = F.position(F.lower(s), low), F.position(F.lower(bare), low)
    return F.when(at > 0, F.substring(text, at, F.length(s))).when(again > 0, F.substring(text, again, F.length(bare)))


def locate_spans(spans: Column, excerpt: Column, most: int = 2) -> Column:
    """The answer made of exact stretches of an excerpt, joined by blanks and capitalised; null if a span is missing, null, or there are none or too many."""
    text = F.regexp_replace(excerpt, r"(?U)\s+", " ")
    found = F.transform(spans, lambda s: _locate(s, text))
    ok = (F.size(spans) > 0) & (F.size(spans) <= most) & ~F.exists(found, lambda x: x.isNull())
    return F.when(ok, _capitalised(F.trim(F.array_join(found, " "))))


def is_subsequence(a: Column, b: Column) -> Column:
    """Whether the characters of ``a`` stand in ``b`` in this order: a fold with a pointer that moves past each hit, or off the end."""
    chars = F.filter(F.split(a, ""), lambda c: c != "")

    def step(at: Column, ch: Column) -> Column:
        hit = F.position(ch, F.substring(b, at + 1, F.lit(1_000_000_000)))
        return F.when((at < 0) | (hit == 0), F.lit(-1)).otherwise(at + hit)

    return F.aggregate(chars, F.lit(0), step) >= 0


def refurbished_spans(spans: Column, excerpt: Column, most: int = 2) -> Column:
    """The answer of spans (verbatim, refurbished): the verbatim form must stand in the excerpt, the refurbished one may add no letter to it."""
    text = F.lower(F.regexp_replace(excerpt, r"(?U)\s+", " "))

    def one(s: Column) -> Column:
        v = collapse(s["verbatim"])
        bare = F.regexp_replace(v, "[.,;:\"']+$", "")
        real = F.when((v != "") & (F.position(F.lower(v), text) > 0), v).when((bare != "") & (F.position(F.lower(bare), text) > 0), bare)
        new = F.when(F.coalesce(collapse(s["refurbished"]), F.lit("")) != "", collapse(s["refurbished"])).otherwise(real)
        return F.when(real.isNotNull() & is_subsequence(letters(new), letters(real)), new)

    found = F.transform(spans, one)
    ok = (F.size(spans) > 0) & (F.size(spans) <= most) & ~F.exists(found, lambda x: x.isNull())
    return F.when(ok, _capitalised(F.trim(F.array_join(found, " "))))


def verse_spans(spans: Column, excerpt: Column, most: int = 2) -> Column:
    """Spans of verse: words matched whatever white space lies between, the excerpt's line breaks kept, stanzas joined by a blank line; case counts."""

    def one(s: Column) -> Column:
        words = F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")
        pattern = F.array_join(F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), "\\s+")
        return F.when(F.size(words) > 0, F.regexp_substr(excerpt, pattern))

    found = F.transform(spans, one)
    ok = (F.size(spans) > 0) & (F.size(spans) <= most) & ~F.exists(found, lambda x: x.isNull())
    return F.when(ok, F.array_join(found, "\n\n"))


# ---- replies --------------------------------------------------------------------------------------


def reply_array(c: Column, strict: bool = False) -> Column:
    """The JSON array in a model's reply, as text: thoughts and fences cut away, and what stands outside the outermost brackets (in strict mode then null)."""
    s = F.regexp_replace(c, r"(?s)<think>.*?</think>", "")
    s = F.regexp_replace(s, r"(?s)^\s*```[A-Za-z]*\s*|\s*```\s*$", "")
    s = F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
    inner = F.regexp_extract(s, r"(?s)\[.*\]", 0)
    if strict:
        return F.when(has(s, r"(?s)^\[.*\]$"), s)
    return F.when(inner != "", inner)


def split_numbered(q: Column, a: Column) -> Column:
    """A question that swallowed its neighbours, cut at their numbers: array of (q, a), or null where no clean cut exists.

    Every part but the last must hold its own answer after its question mark; the last takes the answer.
    """
    # fixed pattern: spoilt numbers, marks and numbers between questions
    cut = r"(?iU)\s+(?:go|gt|gi|g0|8o|ioo|100)\.\s+|\s+q\.\s*\d+[.\s]\s+|\s+\d{1,3}\.\s+(?=[a-z][a-z])"
    parts = F.transform(F.split(q, cut), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    n = F.size(parts)

    def one(p: Column, i: Column) -> Column:
        at = F.locate("?", p)
        head = F.regexp_replace(F.substring(p, F.lit(1), at), r"(?U)^\s+|\s+$", "")
        tail = F.regexp_replace(F.substring(p, at + 1, F.lit(1_000_000_000)), r"(?U)^\s+|\s+$", "")
        last = i == n - 1
        return F.struct(F.when(last, p).otherwise(head).alias("q"), F.when(last, a).otherwise(tail).alias("a"), (last | ((at > 0) & (head != "") & (tail != ""))).alias("ok"))

    rows = F.filter(F.transform(parts, one), lambda r: (r["q"] != "") | ~r["ok"])
    out = F.transform(rows, lambda r: F.struct(r["q"].alias("q"), r["a"].alias("a")))
    return F.when((n >= 2) & ~F.exists(rows, lambda r: ~r["ok"]) & (F.size(out) >= 2), out)
