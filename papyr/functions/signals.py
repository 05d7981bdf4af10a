"""Row-level quality signals as native column expressions.

Every function takes a text column and returns a column; nothing leaves the JVM. Null texts give null,
unless said otherwise. Patterns are Java regular expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Function words whose share tells running prose.
STOP_WORDS = (
    "the of and to a in is that it for as was with his he be not by this had she at they or an which we you from are his her "
    "their its but have has one all were their when there been who will more no if out so up would about into"
).split()
# Words that open a text which goes on from something it doesn't hold.
REFERRING_OPENERS = (
    "this that these those he she they him her his their them such thus hence therefore however moreover nevertheless besides "
    "furthermore accordingly consequently meanwhile likewise which who whom whose"
).split()

# Fixed patterns of the routing signals.
ORDINAL = r"(?iU)\b(1st|2nd|3rd|\d+th|firstly|secondly|thirdly)\b"
OPINION = r"(?iU)\b(pleasant\w*|best|worst|admirable|agreeable|beautiful|ought|should|prefer\w*|delightful|charming|excellent|finest|noble)\b"
REASON = r"(?iU)\b(because|therefore|thus|hence|since|consequently|inasmuch)\b"
SPEECH = r"(?iU)\b(said|asked|replied|cried|answered|exclaimed|demanded|told|spoke|quoth)\b"
QUOTE = "[\"“”‘’]"
FIRST_PERSON = r"(?iU)\b(i|we|my|our|me|us)\b"
PAST = r"(?U)(?<=\w)ed\b"  # of a word that ends so
STRONG_FORM = (
    r"(?iU)\b(be it enacted|be it ordained|by the authority of the same|in this present parliament|know all men by these presents|in witness whereof|"
    r"this indenture|given under my hand|resolved,? that|be it resolved|your obedient servant|yours (faithfully|truly|sincerely|obediently)|"
    r"i have the honour|we beseech thee|vouchsafe)\b"
)
WEAK_FORM = (
    r"(?iU)\b(whereas|provided,? that|an act (to|for)|enacting|plaintiff|defendant|aforesaid|hereinbefore|hereinafter|the said |to wit|whereof|indictment|"
    r"complainant|dear sir|my dear \w+|i beg to|i am, sir|mr\.? president|fellow[- ]citizens|gentlemen of the|o lord|almighty god|thy servant)\b"
)
CONNECTIVE = r"(?iU)\b(therefore|hence|thus|since|because|consequently|whence|accordingly|it follows|for this reason|so that|if|then|let|suppose|assume|given)\b"
QUANTITY = (
    r"(?iU)\b(equals?|angle|triangle|rectangle|square|squared|circle|ratio|proportion|multiply|multiplied|divide|divided|product|quotient|sum|difference|subtract|"
    r"factor|exponent|logarithm|sine|cosine|tangent|root|radius|diameter|circumference|perpendicular|parallel|hypotenuse|axis|"
    r"velocity|force|pressure|weight|mass|volume|density|temperature|heat|energy|momentum|gravity|gravitation|acceleration|friction|lever|fulcrum|inertia|"
    r"coefficient|current|voltage|resistance|ampere|volt|ohm|calorie|acid|alkali|oxygen|hydrogen|carbon|nitrogen|compound|element|reaction|"
    r"solution|atom|molecule|combustion|oxide|equation|formula|theorem|proposition|proof|quantity|degrees?|per\s*cent|"
    r"foot|feet|inch(?:es)?|pound|ounce|gallon|cubic|calculate|computed?|measure[ds]?)\b|[=×÷√°]"
)
HEDGE = r"(?iU)\b(?:" + "|".join((
    r"not (?:certainly |precisely |exactly |yet )?known",
    r"(?:is|are|remains?|was|were) (?:still |yet |as yet )?(?:unknown|obscure|unsettled|undetermined|unascertained)",
    r"cannot (?:be |now be )?(?:known|determined|ascertained|decided|explained|said)",
    r"(?:authorities|opinions|writers|physicians|naturalists|historians|philosophers|critics) (?:differ|are divided|are at variance)",
    r"(?:a )?matter of (?:conjecture|dispute|doubt|uncertainty)",
    r"open to (?:doubt|dispute|question)",
    r"little is (?:certainly )?known",
    r"(?:we|I) (?:are (?:wholly |as yet )?ignorant|do not know|cannot (?:say|tell|determine))",
    r"no one (?:knows|can tell)",
    r"impossible to (?:say|determine|ascertain|decide|know)",
    r"(?:difficult|not easy) to (?:say|determine|decide)",
    r"remains? (?:a )?(?:mystery|secret)",
    r"has not (?:yet |as yet )?been (?:determined|ascertained|explained|discovered|settled)",
    r"(?:the )?(?:date|year|name|record|account) (?:is|was) lost",
    r"(?:no|not any) (?:record|account|evidence) (?:exists|remains|survives|can be found)",
    r"(?:no record|no account) (?:has been|is|was) (?:found|preserved|left|kept)",
    r"(?:the )?(?:record|account|evidence) (?:is|was) (?:wanting|insufficient)",
    r"(?:we|I) have no means of (?:knowing|determining|ascertaining|deciding)",
    r"(?:not|never) recorded",
    r"cannot safely be affirmed",
    r"(?:idle|vain) to (?:conjecture|speculate)",
    r"(?:we|I) (?:refrain|forbear) from (?:conjecture|speculation)",
    r"beyond (?:our|human) (?:knowledge|ken)",
    r"(?:is|are|remains?|was|were) (?:still |yet |as yet )?doubtful",
    r"in (?:doubt|dispute)",
)) + r")\b"
NO_HEDGE = (
    r"(?iU)\b(?:unknown|uncertain)\s+(?:quantity|quantities|resistance|factor|contingenc(?:y|ies)|light|grave|friend|to\s+our\s+forefathers)\b|"
    r"\b(?:residence|holder|party|parties|person|object|thing|position|place)[^.]{0,90}\bis unknown\b"
)
BROKEN_MATH = r"(?U)=\s*=|[=×÷]\s*[·;]|[·;]\s*="
LEADER = r"\.{2,}|_{2,}"
QA_MARK = r"(?iU)(?:^|\n)\s*(?:Q\.|A\.|Ques\b|Ans\b|Question\b|Answer\b)"
TURN_MARK = r"(?iU)(?:^|\n|\.\s)\s*(?:Q\.|A\.|Ques\b|Ans\b)"
SPEAKER = "(?U)(?:^|(?<=[.!?”\"'])\\s)([A-Z][a-z]{0,9}\\.)(?=\\s+[A-Z“\"'])"
FOREIGN = "[\\x{3000}-\\x{30FF}\\x{3400}-\\x{9FFF}\\x{AC00}-\\x{D7A3}\\x{F900}-\\x{FAFF}\\x{FF00}-\\x{FFEF}\\x{FFFD}\\x{200B}-\\x{200D}\\x{FEFF}]"
GIBBERISH = r"(?<![A-Za-z0-9])(?:(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]+|[0-9A-Za-z&&[^aeiouyAEIOUY]]{4,})(?![A-Za-z0-9])"
FIGURE = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"
# All but ASCII and the signs – — ‘ ’ “ ” …, which are neither of words nor of cases.
NOT_PLAIN = r"[\x{80}-\x{2012}\x{2015}-\x{2017}\x{201A}\x{201B}\x{201E}-\x{2025}\x{2027}-\x{10FFFF}]"
CONTROL = r"[\x00-\x1F\x80-\x9F]"
NUMBERED = r"(?U)\b[Qq][.\s]\s*\d+[.\s]|\b\d{1,3}\.\s+[A-Z][a-z]"


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def has(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def plain(pattern: str) -> str:
    """A fixed pattern without its flags for case and Unicode, which says the same of text in lower case without :data:`NOT_PLAIN`, and is faster."""
    return pattern.replace("(?iU)", "").replace("(?U)", "")


def collapse(c: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """The words between white space; none for blank text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def word_count(c: Column) -> Column:
    return count(c, r"(?U)\S+")


def sentences(c: Column) -> Column:
    """Sentences of collapsed text: cut after . ! ? before a capital or figure, with or without an opening quote or bracket."""
    return F.filter(F.split(collapse(c), "(?<=[.!?])\\s+(?=[\"'(]?[A-Z0-9])"), lambda s: s != "")


def strip_lines(c: Column) -> Column:
    """The text without bare numbers, short roman numerals, lines without letters, short notes and running heads in capitals. Blank lines stay."""

    def keep(s: Column) -> Column:
        words = word_count(s)
        note = has(s, "^[*†‡]") & (words <= 12)
        head = (F.length(s) <= 80) & (words <= 10) & (count(s, r"\p{Lu}") > 0.7 * count(s, r"\p{L}"))
        return (s == "") | ~(~has(s, r"\p{L}") | has(s, r"^[\d.,;:\-—\s]+$") | has(s, "(?i)^[ivxlcdm]{1,8}$") | note | head)

    # a lambda's argument is computed once, an expression wherever it stands
    trimmed = lambda line: F.array(F.regexp_replace(line, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(F.split(c, "\n"), lambda line: F.exists(trimmed(line), keep)), "\n")


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def quality_of(solid: Column, letters: Column, figures: Column, words: Column, stop: Column, per: Column) -> Column:
    """:func:`region_quality` of counts: signs but white space, letters, figures, words of plain letters, function words, and words a sentence. 0 without words."""
    score = (
        _clamp((F.try_divide(letters, solid) - 0.60) / 0.30)
        + _clamp((0.05 - F.try_divide(figures, solid)) / 0.05)
        + _clamp((F.try_divide(stop, words) - 0.20) / 0.15)
        + _clamp((per - 8) / 12)
    ) / 4
    return F.when((solid > 0) & (words > 0), score).otherwise(0.0)


def region_quality(c: Column) -> Column:
    """0 to 1: the mean of four clamped terms for letters, figures, function words and sentence length. 0 without words."""
    solid = F.length(F.regexp_replace(c, r"(?U)\s", ""))
    words = count(c, "[A-Za-z]+")
    stop = count(c, r"(?i)(?<![A-Za-z])(?:" + "|".join(dict.fromkeys(STOP_WORDS)) + r")(?![A-Za-z])")
    parts = F.size(sentences(c))
    per = F.coalesce(F.try_divide(word_count(c), parts), F.lit(0.0))
    return F.when(c.isNotNull(), quality_of(solid, count(c, r"\p{L}"), count(c, FIGURE), words, stop, per))


def first_word(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"(?U)^\s*([A-Za-z]+)", 1))


def is_self_contained(c: Column) -> Column:
    """Whether a text doesn't open on a reference to something before it."""
    return ~first_word(c).isin(REFERRING_OPENERS)


def has_affordance(c: Column) -> Column:
    """Whether a text is no form or table of dot leaders."""
    return ~(F.contains(c, F.lit("..")) | F.contains(c, F.lit("__"))) | (count(c, LEADER) < 2)


def foreign_count(c: Column) -> Column:
    return F.when(F.octet_length(c) == F.length(c), 0).otherwise(count(c, FOREIGN))


def gibberish_ratio(c: Column) -> Column:
    """Share of tokens that mix letters and figures, or have four signs and no vowel."""
    return F.when(has(c, GIBBERISH), F.try_divide(count(c, GIBBERISH), count(c, "[A-Za-z0-9]+"))).otherwise(F.when(c.isNotNull(), 0.0))


def is_garbage(c: Column) -> Column:
    return (foreign_count(c) >= 2) | (gibberish_ratio(c) > 0.10)


def ocr_score(c: Column) -> Column:
    """Share of tokens that look like spoilt formulas or fragments, to three places; 0 below 20 tokens."""

    def bad(raw: Column) -> Column:
        t = F.btrim(raw, F.lit(".,;:()[]\"'"))
        core = F.regexp_replace(t, "[^A-Za-z]", "")
        mixed = has(t, r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]") & has(t, r"\p{L}")
        return (t != "") & (has(t, "[=×÷√°∴±≤≥≠∑∏∫]") | mixed | ((F.length(core) >= 4) & ~has(core, "(?i)[aeiouy]")))

    t = tokens(c)
    return F.when(F.size(t) >= 20, F.bround(F.size(F.filter(t, bad)) / F.size(t), 3)).otherwise(F.when(c.isNotNull(), 0.0))


def has_broken_math(c: Column) -> Column:
    return has(c, BROKEN_MATH)


def is_composition(c: Column, form: Callable[[str], str] = str) -> Column:
    """Whether a text is a composed document: one strong phrase, or three weak ones. ``form`` fits the patterns to the text, see :func:`plain`."""
    return has(c, form(STRONG_FORM)) | (count(c, form(WEAK_FORM)) >= 3)


def narrative_signal(c: Column, words: Column | None = None, past: Column | None = None, speech: Column | None = None) -> Column:
    """0 to 1 for scenes with speakers and events; quotes count only beside a verb of speech. Counts that are known may be given."""
    w = word_count(c) if words is None else words
    past, speech = count(c, PAST) if past is None else past, count(c, SPEECH) if speech is None else speech
    quotes = F.when(speech > 0, count(c, QUOTE)).otherwise(0)
    score = F.try_divide(speech + quotes, w) * 12 + F.try_divide(past, w) * 2
    return F.when(w >= 20, F.least(F.lit(1.0), score)).otherwise(F.when(c.isNotNull(), 0.0))


def affordance_label(c: Column, form: Callable[[str], str] = str, words: Column | None = None, past: Column | None = None, speech: Column | None = None) -> Column:
    """The coarse route of an excerpt, the first that applies. ``form`` fits the patterns to the text, see :func:`plain`; counts that are known may be given."""
    past = count(c, PAST) if past is None else past
    return (
        F.when(is_composition(c, form), "composition")
        .when(has(c, form(ORDINAL)) & (past < 6), "procedural")
        .when((count(c, form(FIRST_PERSON)) >= 2) & has(c, form(OPINION)), "opinion")
        .when(narrative_signal(c, words, past, speech) >= 0.3, "narrative")
        .when(has(c, form(REASON)), "argument")
        .when((past >= 8) & has(c, form(r"(?U)\b1[5-9]\d\d\b")), "narrative")
        .otherwise(F.when(c.isNotNull(), "expository"))
    )


def stem_signal(c: Column) -> Column:
    """0 to 1: reasoning connectives times quantitative words, each capped."""
    score = F.least(count(c, CONNECTIVE), F.lit(5)) / 5 * (F.least(count(c, QUANTITY), F.lit(8)) / 8)
    return F.when(word_count(c) >= 20, score).otherwise(F.when(c.isNotNull(), 0.0))


def has_calibration_hedge(c: Column) -> Column:
    return has(c, HEDGE) & ~has(c, NO_HEDGE)


def conversational_signal(c: Column) -> Column:
    """0 to 1 for lessons in question and answer; verbs of speech count against it."""
    w = word_count(c)
    score = (count(c, r"\?") + 4 * count(c, QA_MARK)) / w * 9 - count(c, SPEECH) / w * 12
    return F.when(w >= 20, _clamp(score)).otherwise(F.when(c.isNotNull(), 0.0))


def is_structured_dialogue(c: Column) -> Column:
    """Two marks of question or answer, or speaker labels used twice or more that make up three turns."""
    labels = F.regexp_extract_all(c, F.lit(SPEAKER), F.lit(1))
    repeated = F.size(F.filter(labels, lambda x: F.size(F.filter(labels, lambda y: x == y)) >= 2))
    return (count(c, TURN_MARK) >= 2) | (repeated >= 3)


def garbage_ratio(c: Column) -> Column:
    """Share of control characters, line breaks and tabs included."""
    return count(c, CONTROL) / F.greatest(F.length(c), F.lit(1))


def turn_rule(c: Column) -> Column:
    """The first rule that a turn breaks, or null."""
    return (
        F.when(has(c, r"(?iU)Written\.\s+Played\."), "notation")
        .when(has(c, r"(?iU)(?<!\w)(?:[itrm12345] ){4,}"), "fingering")
        .when(has(c, r"(?dU).{20,}[Qq]\.\s*\d{1,3}[\.\s]"), "bleed")
        .when(garbage_ratio(c) > 0.08, "garbage_chars")
    )


def conversation_rule(turns: Column) -> Column:
    """The first rule that any turn of a conversation breaks, in the order of turns; null if none."""
    return F.get(F.filter(F.transform(turns, lambda t: turn_rule(t["content"])), lambda r: r.isNotNull()), F.lit(0))


def is_bleed_candidate(q: Column, a: Column) -> Column:
    """Whether an answer, or the second half of its question, seems to hold a numbered question."""
    half = F.substring(q, F.floor(F.length(q) / 2).cast("int") + 1, F.length(q))
    return has(a, NUMBERED) | has(half, NUMBERED)


def token_estimate(*texts: Column) -> Column:
    """A quarter of the characters; nulls count nothing."""
    return F.floor(sum((F.coalesce(F.length(t), F.lit(0)) for t in texts), F.lit(0)) / 4).cast("int")


OUTER = ".,;:!?()[]{}\"'“”‘’…—-«»"


def is_notation(word: Column) -> Column:
    """Whether a word is no clean prose: figures, signs, glued forms. Ordinals and bare punctuation are prose."""
    core = F.btrim(F.trim(word), F.lit(OUTER))
    return (core != "") & ~has(core, r"(?i)^\d+(?:st|nd|rd|th)$") & ~has(core, "^[A-Za-z]+(?:['’-][A-Za-z]+)*$")


def notation_count(c: Column) -> Column:
    return F.size(F.filter(tokens(c), is_notation))


def has_notation(c: Column) -> Column:
    return F.exists(tokens(c), is_notation)


def mask_notation(words: Column, bits: Column, sizes: Column) -> Column:
    """(words, bits, bytes) without the words of notation, from three parallel arrays."""
    kept = F.filter(F.arrays_zip(words.alias("words"), bits.alias("bits"), sizes.alias("bytes")), lambda x: ~is_notation(x["words"]))
    return F.struct(F.transform(kept, lambda x: x["words"]).alias("words"), F.transform(kept, lambda x: x["bits"]).alias("bits"), F.transform(kept, lambda x: x["bytes"]).alias("bytes"))


# Fixed patterns: words of talk, address by rank or sex, and a name's possession at the opening.
TALK = r"(?iU)\b(i|you|we|my|your|our|me|us|is|are|was|were|be|do|does|did|come|go|let|will|shall|not|no|yes|have|has|there|here|god|never|ever|pray|tell|know|think|say)\b"
ADDRESS = r"(?iU)\b(madam|madame|ma'am|sir|mister|mistress|miss)\b"
POSSESSION = r"(?U)^[A-Z][a-z]+'s\b"
# Words that lose nothing by a typing error.
SMALL_WORDS = (
    "the and that have for not with you this but his from they she her him will what when which there their would could should been were was are its into "
    "than then them these those some such only other any very does did how why who whom whose all can may"
).split()
# Fixed patterns: what a line of dialogue may not hold, and a reply's opening.
ARCHAIC = r"(?iU)\b(thou|thee|thy|thine|wilt|hath|doth|prithee|methinks|nay)\b"
NARRATION = r"(?iU)\b(said|replied|answered|asked|cried|returned|observed|exclaimed|rejoined|remarked|murmured|whispered|retorted|inquired|ejaculated)\b"
DIALECT = r"(?iU)\b\w*'(?:d|ll|s|t|n|em|im|ee)\b|\b(?:wos|wot|yer|aint|dunno|summat|nowt|hisself|theirselves|know'd|s'pose)\b"
TITLED_NAME = r"(?U)\b(Mr|Mrs|Miss|Dr|Lady|Lord|Sir|Madame|Monsieur)\.?\s+[A-Z][a-z]+"
REPLY_OPENING = (
    r"(?iU)^\s*(and|but|then|so|yet|nor|for|yes|no|indeed|certainly|quite|true|exactly|precisely|of course|not at all|nothing|nobody|never|neither|both|either)\b"
)


def is_speechlike(c: Column) -> Column:
    """Whether an utterance could be said to anyone: it holds a word of talk, no address by rank or sex, and opens on no name's possession."""
    return has(c, TALK) & ~has(c, ADDRESS) & ~has(c, POSSESSION)


def content_words(c: Column) -> Column:
    """The words of five letters or more that carry meaning to lose, as they stand."""
    letters = lambda t: F.lower(F.regexp_replace(t, "[^A-Za-z]", ""))
    return F.filter(tokens(c), lambda t: (F.length(letters(t)) >= 5) & ~letters(t).isin(SMALL_WORDS))


def clean_turn(c: Column, role: Column, names: str | None = None) -> Column:
    """A line of dialogue as a turn of its own, or null.

    Collapsed, without outer quotes and trailing marks, with a final stop; 4 to 320 characters, opening on a capital, without figures,
    old pronouns, narration, curly quotes, titled names and the book's ``names`` (a pattern); an answer has three words at
    least, asks nothing and speaks no dialect.
    """
    s = F.regexp_replace(collapse(c), "^[\"'“”]+|[\"'“”]+$", "")
    s = F.regexp_replace(F.regexp_replace(s, "[,;:–—-]+$", ""), r"(?U)^\s+|\s+$", "")
    s = F.when((s == "") | has(s, "[.!?]$"), s).otherwise(F.concat(s, F.lit(".")))
    barred = [r"(?U)\d", ARCHAIC, NARRATION, "[“”]", TITLED_NAME, *([names] if names else [])]
    bad = F.lit(False)
    for pattern in barred:
        bad = bad | has(s, pattern)
    answers = (word_count(s) >= 3) & ~has(s, r"\?$") & ~has(s, DIALECT)
    return F.when(F.length(s).between(4, 320) & has(s, r"^\p{Lu}") & ~bad & ((role != "assistant") | answers), s)


def name_pattern(speakers: list[str]) -> str | None:
    """A pattern for the names of a book's speakers, of four letters or more, without those that are common words; null without any."""
    # fixed values: speakers too common as words to turn a line down for
    common = set(
        "will may grace rose mark hope faith young little old man woman boy girl doctor captain general king queen prince count duke madame monsieur father mother uncle "
        "aunt lord lady miss mrs the one first second other".split()
    )
    own = sorted({w for s in speakers for w in re.findall("[A-Za-z]{4,}", s or "") if w.lower() not in common}, key=lambda w: (-len(w), w))
    return r"(?U)\b(?:" + "|".join(own) + r")\b" if own else None
