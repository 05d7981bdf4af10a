"""SQL of the routing signals, with lists and patterns of its own: what the engine's tables say is checked against them, not taken from them."""

from __future__ import annotations

SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\pL\pM\p{Nd}\p{Pc}\x{200C}\x{200D}"

# Fixed values, as the signals state them.
SPEECH = "said|asked|replied|cried|answered|exclaimed|demanded|told|spoke|quoth"
FIRST = "i|we|my|our|me|us"
REASON = "because|therefore|thus|hence|since|consequently|inasmuch"
ORDINAL = r"1st|2nd|3rd|\p{Nd}+th|firstly|secondly|thirdly"
OPINION = rf"pleasant[{WORD}]*|best|worst|admirable|agreeable|beautiful|ought|should|prefer[{WORD}]*|delightful|charming|excellent|finest|noble"
STRONG = (
    "be it enacted|be it ordained|by the authority of the same|in this present parliament|know all men by these presents|in witness whereof|this indenture|given under my hand|resolved,? that|be it resolved|"
    "your obedient servant|yours (?:faithfully|truly|sincerely|obediently)|i have the honour|we beseech thee|vouchsafe"
)
WEAK = (
    rf"whereas|provided,? that|an act (?:to|for)|enacting|plaintiff|defendant|aforesaid|hereinbefore|hereinafter|the said |to wit|whereof|indictment|complainant|dear sir|my dear [{WORD}]+|"
    "i beg to|i am, sir|mr\\.? president|fellow[- ]citizens|gentlemen of the|o lord|almighty god|thy servant"
)
CONNECTIVE = "therefore|hence|thus|since|because|consequently|whence|accordingly|it follows|for this reason|so that|if|then|let|suppose|assume|given"
QUANTITY = (
    "equals?|angle|triangle|rectangle|square|squared|circle|ratio|proportion|multiply|multiplied|divide|divided|product|quotient|sum|difference|subtract|factor|exponent|logarithm|sine|cosine|tangent|root|radius|"
    "diameter|circumference|perpendicular|parallel|hypotenuse|axis|velocity|force|pressure|weight|mass|volume|density|temperature|heat|energy|momentum|gravity|gravitation|acceleration|friction|lever|fulcrum|inertia|"
    "coefficient|current|voltage|resistance|ampere|volt|ohm|calorie|acid|alkali|oxygen|hydrogen|carbon|nitrogen|compound|element|reaction|solution|atom|molecule|combustion|oxide|equation|formula|theorem|proposition|"
    rf"proof|quantity|degrees?|per[{SPACE}]*cent|foot|feet|inch(?:es)?|pound|ounce|gallon|cubic|calculate|computed?|measure[ds]?"
)
HEDGE = "|".join((
    "not (?:certainly |precisely |exactly |yet )?known", "(?:is|are|remains?|was|were) (?:still |yet |as yet )?(?:unknown|obscure|unsettled|undetermined|unascertained)",
    "cannot (?:be |now be )?(?:known|determined|ascertained|decided|explained|said)", "(?:authorities|opinions|writers|physicians|naturalists|historians|philosophers|critics) (?:differ|are divided|are at variance)",
    "(?:a )?matter of (?:conjecture|dispute|doubt|uncertainty)", "open to (?:doubt|dispute|question)", "little is (?:certainly )?known", "(?:we|i) (?:are (?:wholly |as yet )?ignorant|do not know|cannot (?:say|tell|determine))",
    "no one (?:knows|can tell)", "impossible to (?:say|determine|ascertain|decide|know)", "(?:difficult|not easy) to (?:say|determine|decide)", "remains? (?:a )?(?:mystery|secret)",
    "has not (?:yet |as yet )?been (?:determined|ascertained|explained|discovered|settled)", "(?:the )?(?:date|year|name|record|account) (?:is|was) lost", "(?:no|not any) (?:record|account|evidence) (?:exists|remains|survives|can be found)",
    "(?:no record|no account) (?:has been|is|was) (?:found|preserved|left|kept)", "(?:the )?(?:record|account|evidence) (?:is|was) (?:wanting|insufficient)", "(?:we|i) have no means of (?:knowing|determining|ascertaining|deciding)",
    "(?:not|never) recorded", "cannot safely be affirmed", "(?:idle|vain) to (?:conjecture|speculate)", "(?:we|i) (?:refrain|forbear) from (?:conjecture|speculation)", "beyond (?:our|human) (?:knowledge|ken)",
    "(?:is|are|remains?|was|were) (?:still |yet |as yet )?doubtful", "in (?:doubt|dispute)",
))
NO_HEDGE = (
    rf"(?:unknown|uncertain)[{SPACE}]+(?:quantity|quantities|resistance|factor|contingenc(?:y|ies)|light|grave|friend|to[{SPACE}]+our[{SPACE}]+forefathers)",
    "(?:residence|holder|party|parties|person|object|thing|position|place)[^.]{0,180}[^." + WORD + "]is unknown",
)
STOP = (
    "the of and to a in is that it for as was with his he be not by this had she at they or an which we you from are her its but have has one all were their when there been who will more no if out so up would about into"
).split()


def doubled(c: str) -> str:
    """Lower case, with every sign between words twice, so that whole words can be told without looking ahead."""
    return rf"regexp_replace(replace(lower({c}), 'ſ', 's'), '([^{WORD}])', '\1\1', 'g')"


def _twice(alternatives: str) -> str:
    return alternatives.replace(" ", "  ").replace(",?", "(?:,,)?").replace("\\.?", "(?:\\.\\.)?").replace("[- ]", "(?:--|  )").replace("am,", "am,,")


def words(alternatives: str, c: str = "doubled") -> str:
    """How often one of the alternatives stands as whole words in a doubled text."""
    return f"len(regexp_extract_all({c}, '(?:^|[^{WORD}])(?:{_twice(alternatives)})(?:[^{WORD}]|$)'))"


def holds(alternatives: str, c: str = "doubled") -> str:
    return f"regexp_matches({c}, '(?:^|[^{WORD}])(?:{_twice(alternatives)})(?:[^{WORD}]|$)')"


def tokens(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{SPACE}]+')"


def past(c: str) -> str:
    return f"len([x for x in regexp_extract_all({c}, '[{WORD}]+') if x like '_%ed'])"


def sentences(c: str) -> str:
    folded = f"regexp_replace({c}, '[{SPACE}]+', ' ', 'g')"
    return rf"""string_split(regexp_replace(trim({folded}), '([.!?])\s+(["''(]?[A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1))"""


def narrative() -> str:
    return "(CASE WHEN w < 20 THEN 0.0 ELSE least(1.0, (speech + CASE WHEN speech > 0 THEN quotes ELSE 0 END)::DOUBLE / w * 12 + past::DOUBLE / w * 2) END)"


def signals(c: str) -> str:
    """Columns of a text ``c`` that stands beside its ``doubled`` form."""
    return rf"""len({tokens(c)}) AS w, {words(SPEECH)} AS speech, len(regexp_extract_all({c}, '["“”‘’]')) AS quotes, {past(c)} AS past, {holds(STRONG)} OR {words(WEAK)} >= 3 AS composed, {holds(ORDINAL)} AS ordinal,
        {words(FIRST)} AS first_person, {holds(OPINION)} AS opinion, {holds(REASON)} AS reason, regexp_matches({c}, '(?:^|[^{WORD}])1[5-9]\p{{Nd}}\p{{Nd}}(?:[^{WORD}]|$)') AS dated"""


def label() -> str:
    return f"""CASE WHEN composed THEN 'composition' WHEN ordinal AND past < 6 THEN 'procedural' WHEN first_person >= 2 AND opinion THEN 'opinion' WHEN {narrative()} >= 0.3 THEN 'narrative'
        WHEN reason THEN 'argument' WHEN past >= 8 AND dated THEN 'narrative' ELSE 'expository' END"""


def hedge(c: str, twice: str = "doubled") -> str:
    # the exceptions' own blanks may be any white space, of which each stands twice
    return f"({holds(HEDGE, twice)} AND NOT ({holds(NO_HEDGE[0], twice)} OR {holds(NO_HEDGE[1], twice)}))"


def quality(c: str, name: str) -> str:
    """A CTE ``name`` of (key, clean text columns..., quality) over ``c``; the source must be given as ``src``."""
    stop = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
    return f"""CASE WHEN length(regexp_replace({c}, '[{SPACE}]', '', 'g')) = 0 OR len(regexp_extract_all({c}, '[A-Za-z]+')) = 0 THEN 0.0 ELSE (
        greatest(0.0, least(1.0, (length(regexp_replace({c}, '[^\\pL]', '', 'g'))::DOUBLE / length(regexp_replace({c}, '[{SPACE}]', '', 'g')) - 0.60) / 0.30))
        + greatest(0.0, least(1.0, (0.05 - length(regexp_replace({c}, '[^\\p{{Nd}}²³¹⁰⁴-⁹₀-₉]', '', 'g'))::DOUBLE / length(regexp_replace({c}, '[{SPACE}]', '', 'g'))) / 0.05))
        + greatest(0.0, least(1.0, (len([x for x in regexp_extract_all({c}, '[A-Za-z]+') if lower(x) in {stop}])::DOUBLE / len(regexp_extract_all({c}, '[A-Za-z]+')) - 0.20) / 0.15))
        + greatest(0.0, least(1.0, (coalesce(len({tokens(c)})::DOUBLE / nullif(len([x for x in {sentences(c)} if x <> '']), 0), 0.0) - 8) / 12))) / 4 END AS {name}"""


def garbage(c: str) -> str:
    odd = r"[^\x{3000}-\x{30FF}\x{3400}-\x{9FFF}\x{AC00}-\x{D7A3}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{FFFD}\x{200B}-\x{200D}\x{FEFF}]"
    mixed = f"len([x for x in regexp_extract_all({c}, '[A-Za-z0-9]+') if (regexp_matches(x, '[0-9]') and regexp_matches(x, '[A-Za-z]')) or (length(x) >= 4 and not regexp_matches(x, '[aeiouyAEIOUY]'))])"
    return f"(length(regexp_replace({c}, '{odd}', '', 'g')) >= 2 OR coalesce({mixed}::DOUBLE / nullif(len(regexp_extract_all({c}, '[A-Za-z0-9]+')), 0), 0.0) > 0.10)"


def kept_lines(c: str) -> str:
    """The list of lines that stripping keeps."""
    bare = f"regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"
    return rf"""[x for x in string_split({c}, chr(10)) if ({bare} = '') or not (
            regexp_matches({bare}, '^[0-9.,;:\-—\s]+$') or regexp_matches({bare}, '(?i)^[ivxlcdm]{{1,8}}$') or not regexp_matches(x, '\pL') or (regexp_matches({bare}, '^[*†‡]') and len({tokens('x')}) <= 12)
            or (len({tokens('x')}) <= 10 and length({bare}) <= 80 and length(regexp_replace(x, '[^\p{{Lu}}]', '', 'g')) > 0.7 * length(regexp_replace(x, '[^\pL]', '', 'g'))))]"""


FLAGSHIP = f"""
    WITH k AS (SELECT lang, array_to_string({kept_lines('text')}, chr(10)) AS clean FROM documents WHERE text IS NOT NULL),
    g AS (SELECT lang, coalesce(clean, '') AS clean, {doubled("coalesce(clean, '')")} AS doubled FROM k), s AS (SELECT lang, {signals('clean')}, {quality('clean', 'quality')} FROM g WHERE NOT {garbage('clean')})
    SELECT lang, {label()} AS affordance, count(*) AS documents, round_even(avg(quality), 3) AS quality FROM s GROUP BY ALL"""

AFFORDANCES = rf"""
    WITH d AS (SELECT doc_index, excerpt, {doubled('excerpt')} AS doubled FROM excerpts WHERE excerpt IS NOT NULL),
    s AS (SELECT doc_index, {signals('excerpt')}, {hedge('excerpt')} AS hedge, {words(CONNECTIVE)} AS connectives, {words(QUANTITY)} + len(regexp_extract_all(excerpt, '[=×÷√°]')) AS quantities,
        len(regexp_extract_all(excerpt, '\?')) AS asks, len(regexp_extract_all(replace(excerpt, 'ſ', 's'), '(?i)(?:^|\n)[{SPACE}]*(?:Q\.|A\.|(?:Ques|Ans|Question|Answer)(?:[^{WORD}]|$))')) AS marks FROM d)
    SELECT doc_index, {label()} AS label, CASE WHEN w < 20 THEN 0.0 ELSE round_even(least(connectives, 5) / 5.0::DOUBLE * (least(quantities, 8) / 8.0::DOUBLE), 6) END AS stem, hedge,
        CASE WHEN w < 20 THEN 0.0 ELSE round_even(greatest(0.0, least(1.0, (asks + 4 * marks)::DOUBLE / w * 9 - speech::DOUBLE / w * 12)), 6) END AS conversational, composed FROM s"""

_CLASSES = {
    "knowledge_qa": "knowledge", "reasoning_qa": "reasoning", "stem_reasoning": "stem_reasoning", "narrative_grounded": "narrative_grounded", "narrative_fiction": "narrative_fiction", "composition_qa": "composition",
    "how_to_qa": "how_to", "opinion_qa": "opinion", "verse_qa": "verse", "multiturn_qa": "knowledge", "calibration_qa": "knowledge', 'reasoning', 'stem_reasoning', 'narrative_grounded', 'opinion', 'how_to', 'conversational', 'composition",
}

ROUTE_SOURCES = f"""
    WITH e AS (SELECT doc_index, classes, coalesce(prose_score, 0) >= 0.7 AS prose, regexp_matches(excerpt, '=[{SPACE}]*=|[=×÷][{SPACE}]*[·;]|[·;][{SPACE}]*=') AS broken, {hedge('excerpt', doubled('excerpt'))} AS hedge FROM excerpts WHERE excerpt IS NOT NULL),
    r AS ({' UNION ALL '.join(f"SELECT '{n}' AS route, doc_index FROM e WHERE prose AND list_has_any(classes, ['{k}'])" + (" AND NOT broken" if n != "stem_reasoning" else "") + (" AND hedge" if n == "calibration_qa" else "") + (" AND NOT list_contains(classes, 'narrative_grounded')" if n == "narrative_fiction" else "") for n, k in _CLASSES.items())})
    SELECT route, count(DISTINCT doc_index) AS n FROM r GROUP BY route"""

TURN_RULES = rf"""
    WITH t AS (SELECT dataset, [CASE WHEN regexp_matches(t.content, '(?i)Written\.[{SPACE}]+Played\.') THEN 'notation' WHEN regexp_matches(t.content, '(?i)(?:^|[^{WORD}])(?:[itrm12345] ){{4,}}') THEN 'fingering'
        WHEN regexp_matches(t.content, '.{{20,}}[Qq]\.[{SPACE}]*\p{{Nd}}{{1,3}}[\.{SPACE}]') THEN 'bleed' WHEN length(regexp_replace(t.content, '[^\x00-\x1F\x{{80}}-\x{{9F}}]', '', 'g'))::DOUBLE / greatest(length(t.content), 1) > 0.08 THEN 'garbage_chars' END
        for t in conversations] AS rules FROM conversations_nested)
    SELECT dataset, coalesce([r for r in rules if r IS NOT NULL][1], 'clean') AS rule, count(*) AS n FROM t GROUP BY ALL"""

_NUMBERED = rf"(?:^|[^{WORD}])(?:[Qq][.{SPACE}][{SPACE}]*\p{{Nd}}+[.{SPACE}]|\p{{Nd}}{{1,3}}\.[{SPACE}]+[A-Z][a-z])"
BLEED_CANDIDATES = f"""
    SELECT dataset, count(*) FILTER (WHERE regexp_matches(a, '{_NUMBERED}') OR regexp_matches(substring(q, length(q) // 2 + 1), '{_NUMBERED}')) AS candidates, CAST(sum((length(q) + length(a)) // 4) AS BIGINT) AS tokens
    FROM pairs WHERE q IS NOT NULL AND a IS NOT NULL GROUP BY dataset"""

_ALIKE = "οναρτικχευАОЕРСТХМНКВаоерсхуи"
_POLLUTED = rf"""(length(regexp_replace(x, '[^\p{{Latin}}]', '', 'g')) > length(regexp_replace(x, '[^\pL]', '', 'g')) - length(regexp_replace(x, '[^\p{{Latin}}]', '', 'g'))
    and length(regexp_replace(x, '[^\pL]', '', 'g')) > length(regexp_replace(x, '[^\p{{Latin}}]', '', 'g')) and (regexp_matches(x, '\p{{Greek}}') <> regexp_matches(x, '\p{{Cyrillic}}'))
    and length(regexp_replace(x, '[^{_ALIKE}]', '', 'g')) = length(regexp_replace(x, '[^\pL]', '', 'g')) - length(regexp_replace(x, '[^\p{{Latin}}]', '', 'g')))"""
CONFUSABLES = f"""
    WITH d AS (SELECT doc_id, len([x for x in {tokens('text')} if {_POLLUTED}]) AS words, len([x for x in string_split(text, ' ') if {_POLLUTED}]) > 0 AS changed FROM documents WHERE text IS NOT NULL) SELECT doc_id, words, changed FROM d WHERE words > 0"""

WARNING_CAPS = """
    WITH c AS (SELECT coalesce(list_min([CASE WHEN contains(w, 'question contains the answer proposition') THEN 35 WHEN contains(w, 'unbalanced square brackets') OR contains(w, 'unbalanced parentheses') THEN 40
        WHEN contains(w, 'unbalanced curly quotation marks') OR contains(w, 'unbalanced straight quotation marks') THEN 49 WHEN contains(w, 'probable OCR-split words') THEN 55
        WHEN contains(w, 'dramatic speaker labels flattened into prose') OR contains(w, 'answer appears to end mid-sentence or mid-structure') THEN 60 ELSE 100 END for w in warnings]), 100) AS cap FROM graded_rows)
    SELECT cap, count(*) AS n FROM c GROUP BY cap"""

GRADE_WARNINGS = rf"""
    WITH p AS (SELECT coalesce(q, '') AS q, coalesce(a, '') AS a, CASE WHEN coalesce(a, '') = '' THEN coalesce(q, '') ELSE a END AS t FROM pairs),
    f AS (SELECT *, array_to_string(regexp_extract_all(lower(q), '[a-z0-9]+'), ' ') AS nq, array_to_string(regexp_extract_all(lower(a), '[a-z0-9]+'), ' ') AS na, len(regexp_extract_all(lower(a), '[a-z0-9]+')) AS k FROM p),
    w AS (SELECT unnest([CASE WHEN length(regexp_replace(t, '[^\[]', '', 'g')) <> length(regexp_replace(t, '[^\]]', '', 'g')) THEN 'unbalanced square brackets' END, CASE WHEN length(regexp_replace(t, '[^(]', '', 'g')) <> length(regexp_replace(t, '[^)]', '', 'g')) THEN 'unbalanced parentheses' END,
        CASE WHEN length(regexp_replace(t, '[^“]', '', 'g')) <> length(regexp_replace(t, '[^”]', '', 'g')) THEN 'unbalanced curly quotation marks' END, CASE WHEN length(regexp_replace(t, '[^"]', '', 'g')) % 2 = 1 THEN 'unbalanced straight quotation marks' END,
        CASE WHEN regexp_matches(t, '(?:[:;,]|---?)[{SPACE}]*$') THEN 'answer appears to end mid-sentence or mid-structure' END, CASE WHEN k >= 5 AND contains(nq, na) THEN 'the question contains the answer proposition' END]) AS warning FROM f)
    SELECT warning, count(*) AS n FROM w WHERE warning IS NOT NULL GROUP BY warning"""

MISMATCHES = """
    WITH p AS (SELECT dataset, i, v.a AS a, concat_ws('--', dataset, i) AS key FROM (SELECT dataset, i, max(struct_pack(t := ingested_at, q := coalesce(q, ''), a := coalesce(a, ''))) AS v FROM pairs GROUP BY dataset, i)),
    r AS (SELECT *, substring(md5('bucket:' || key), 1, 3) AS b, row_number() OVER (PARTITION BY substring(md5('bucket:' || key), 1, 3) ORDER BY md5('0:' || key), key) AS r, row_number() OVER (PARTITION BY substring(md5('bucket:' || key), 1, 3) ORDER BY md5('1:' || key), key) AS r1 FROM p)
    SELECT x.dataset, count(*) AS n FROM r x JOIN r y ON x.b = y.b AND x.r = y.r1 WHERE y.a IS DISTINCT FROM x.a GROUP BY x.dataset"""

SQL = {
    "flagship": FLAGSHIP, "affordances": AFFORDANCES, "route_sources": ROUTE_SOURCES, "turn_rules": TURN_RULES, "bleed_candidates": BLEED_CANDIDATES, "confusables": CONFUSABLES, "warning_caps": WARNING_CAPS, "grade_warnings": GRADE_WARNINGS, "mismatches": MISMATCHES,
}
