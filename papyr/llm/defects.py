"""Defects of prompt and response pairs: empty, truncated, refusal, copy, language.

Truncation is judged by a pushdown parser of fences, brackets, quotations, lists and markup, and where an
answer merely lacks its final stop by counts over all answers (which words end sentences, which are
verbs). Copies are found by greedy string tiling, refusals by a small grammar of clauses, and other
languages by script and by word counts that function words bootstrap.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyr.llm.encoding import undo
from papyr.llm.grammar import Grammar
from papyr.llm.tokens import name, names

# Common function words of each language, which start the language counts.
FUNCTION_WORDS = {
    "en": "the of and to in was is that it for with as his on be at by had not are but from they which this have were or an would there their been one all we when".split(),
    "fr": "le la les des du et est une dans que qui pour par sur au avec ne pas plus se cette ce ces sont il elle nous aux comme mais leur sous dès".split(),
    "de": "der die das und ist den dem des ein eine nicht mit von zu auf für sich im als auch es an werden aus er hat dass sie nach wie bei".split(),
    "es": "el la los las de y en que un una por con no del para se al es como más su lo este pero sus sin sobre desde todos".split(),
    "it": "il la di e che un una per in del non si con della è le i lo da al dei nel alla più gli come anche questo questa sono".split(),
}
LANGS = tuple(FUNCTION_WORDS)
_OWN = {k: frozenset(w for w in v if sum(w in o for o in FUNCTION_WORDS.values()) == 1) for k, v in FUNCTION_WORDS.items()}

# Answers that say nothing.
PLACEHOLDERS = frozenset("n/a na none null nil tbd todo tba blank nan undefined empty missing placeholder xxx ? - ... answer ans a".split()) | {"no answer", "to be done", "not available", "no reply", "no response", "left blank", "not answered", "insert answer here", "answer here", "your answer here"}
_MARKER = re.compile(r"^(?:ans(?:wer|w)?|a|r|réponse|antwort|respuesta|risposta)\s*[.:)—–-]+\s*", re.I)
_MARK_ONLY = re.compile(r"^(?:ans(?:wer)?|a|réponse|antwort|respuesta|risposta)$", re.I)
_WORD = re.compile(r"[^\W_]+")
_ANY = re.compile(r"\w")

# ---- counts over all answers ------------------------------------------------------------------

VOCABULARY = 60_000  # most frequent words whose counts are kept
_LETTERS = re.compile(r"[^\W\d_]+")
_EDGE = ".,;:!?\"'()[]{}«»“”‘’—–-¬…"
_END = frozenset(".!?")
_CLOSES = "\"'”’»)]"
# Words before the base form of a verb, and before a participle.
_MODAL = frozenset("may might must shall will never soon always cannot can could should would".split())
_HAD = frozenset("had have has".split())


def turns_of_pairs(pairs: DataFrame) -> DataFrame:
    """(src, rec_id, turns) of question and answer pairs. A null question is a turn with null content."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).cast("string").alias("content"))
    return pairs.select(F.lit("pairs").alias("src"), _rec_id().alias("rec_id"), F.array(turn("user", "q"), turn("assistant", "a")).alias("turns"))


def turns_of_conversations(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.lit("conversations_nested").alias("src"), _rec_id().alias("rec_id"), F.transform("conversations", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns"))


def _rec_id() -> Column:
    return F.concat_ws("--", F.col("dataset"), F.col("i").cast("string"))


def exchanges(turns: list[dict] | None) -> Iterator[tuple[str | None, str | None, bool]]:
    """(question, answer, answered) of each user turn and each assistant turn. A user turn that no assistant turn follows is not answered; an answer without question has question null."""
    question: str | None = None
    open_ = False
    for t in turns or ():
        role = t["role"] if t else None
        if role == "user":
            if open_:
                yield question, None, False
            question, open_ = t["content"], True
        elif role == "assistant":
            yield (question if open_ else None), t["content"], True
            open_ = False
    if open_:
        yield question, None, False


def _flat(b: pa.RecordBatch) -> tuple[list[int], list[str | None], list[str | None]]:
    """Offsets of the records' turns, roles and contents of a batch, without an object for each turn."""
    turns = b.column(b.num_columns - 1)
    offsets = turns.offsets.to_pylist()
    inner = turns.values
    return offsets, inner.field(0).to_pylist(), inner.field(1).to_pylist()


def guess(words: set[str]) -> str | None:
    """The language that a text's function words speak for, if clearly."""
    n = sorted(((len(words & own), k) for k, own in _OWN.items()), reverse=True)
    return n[0][1] if n[0][0] >= 2 and n[0][0] >= 2 * n[1][0] + 1 else None


def count_answers(records: DataFrame) -> DataFrame:
    """(word, total, final, base, past, n_en..n_it) in lower case, over all turns of all records."""

    def run(batches):
        for b in batches:
            by = {k: Counter() for k in (*LANGS, None)}
            final, base, past = Counter(), Counter(), Counter()
            for text in _flat(b)[2]:
                if not text:
                    continue
                tokens = text.lower().split()
                words = [t.strip(_EDGE) for t in tokens]
                by[guess(set(words))].update(words)
                final.update([w for w, t in zip(words, tokens, strict=True) if t[-1] in _END or (t[-1] in _CLOSES and t.rstrip(_CLOSES)[-1:] in _END)])
                base.update([y for x, y in zip(words, words[1:], strict=False) if x in _MODAL])
                past.update([y for x, y in zip(words, words[1:], strict=False) if x in _HAD])
            every = sum(by.values(), Counter())
            keys = [w for w in every if w]
            cols = [[every[w] for w in keys], [final[w] for w in keys], [base[w] for w in keys], [past[w] for w in keys], *[[by[k][w] for w in keys] for k in LANGS]]
            yield pa.RecordBatch.from_arrays([pa.array(names(keys), pa.string()), *[pa.array(c, pa.int64()) for c in cols]], names=["word", "total", "final", "base", "past", *[f"n_{k}" for k in LANGS]])

    columns = ["total", "final", "base", "past", *[f"n_{k}" for k in LANGS]]
    counted = records.select("turns").mapInArrow(run, "word string, " + ", ".join(f"{n} bigint" for n in columns))
    return counted.groupBy("word").agg(*[F.sum(n).alias(n) for n in columns])


@dataclass
class Counts:
    """What the corpus says of its words: a bounded table of the most frequent ones."""

    final: dict[str, float] = field(default_factory=dict)  # share of a word's uses that end a sentence
    verbs: frozenset[str] = frozenset()
    known: frozenset[str] = frozenset()
    odds: dict[str, np.ndarray] = field(default_factory=dict)  # log odds of a word by language

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}  # what follows from the rest isn't sent

    @property
    def prefixes(self) -> frozenset[str]:
        """Beginnings of known words."""
        if "_prefixes" not in self.__dict__:
            self._prefixes = frozenset(w[:i] for w in self.known for i in range(1, len(w)))
        return self._prefixes

    def rows(self) -> tuple[dict[str, int], np.ndarray]:
        """The log odds as rows of a table, by word."""
        if "_rows" not in self.__dict__:
            self._rows = {w: i for i, w in enumerate(self.odds)}, np.array([*self.odds.values()]).reshape(-1, len(LANGS))
        return self._rows


def learn(records: DataFrame, size: int = VOCABULARY) -> Counts:
    rows = count_answers(records).orderBy(F.col("total").desc(), "word").limit(size).collect()
    return make_counts([tuple(r) for r in rows])


def make_counts(rows: list[tuple]) -> Counts:
    every = sum(r[1] for r in rows) or 1
    floor = max(2.0, 5e-6 * every)
    totals = np.array([sum(r[5 + j] for r in rows) for j in range(len(LANGS))], float)
    known, final, verbs, odds = set(), {}, set(), {}
    for word, total, fin, base, past, *langs in rows:
        if total < floor:
            continue
        known.add(word)
        final[word] = fin / total
        if (base > 0.2 * total or past > 0.3 * total) and fin < 0.5 * total:
            verbs.add(word)
        n = np.array(langs, float)
        if n.sum() >= 3:
            expected = n.sum() * totals / max(totals.sum(), 1)
            odds[word] = np.clip(np.log((n + 1.0) / (expected + 1.0)), -4, 4)
    return Counts(final, frozenset(verbs), frozenset(known), odds)


# ---- empty ------------------------------------------------------------------------------------

_SAYS = 3 + max(p.count(" ") + 1 for p in PLACEHOLDERS)
_INVISIBLE = re.compile("[​-‏ -‮⁠-⁤﻿­᠎]")


def is_empty(answer: str | None) -> bool:
    """Null, blank, or nothing but punctuation, a marker or a placeholder."""
    if answer is None:
        return True
    first = answer.split(None, _SAYS)[:_SAYS]
    if len(first) == _SAYS and all(map(_ANY.search, first)):
        return False  # more words than markers and a placeholder have
    if not _ANY.search(answer):
        return True
    s = " ".join(_INVISIBLE.sub("", answer).split())
    for _ in range(2):
        s = _MARKER.sub("", s).strip()
    if not _ANY.search(s) or _MARK_ONLY.match(s):
        return True
    core = re.sub(r"^[\s\[(<{*_\"'“.—-]+|[\s\])>}*_\"'”.!—-]+$", "", s).lower()
    return core in PLACEHOLDERS and not (core == "none" and s[:1] == "N" and s[-1:] == ".")


# ---- truncated --------------------------------------------------------------------------------

_PAIRS = {")": "(", "]": "[", "}": "{", "»": "«"}
_STRUCTURE = re.compile(r"```|</?([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?/?>|[()\[\]{}«»„“”]|(?<!\d)\"|\n[ \t]*(?:[-*•]|\d+[.)])(?=\s|$)|\n[ \t]*\||\n")
# Elements of markup that need no end.
_VOID = frozenset("br hr img input meta link p li td tr th".split())
_QUOTES = ("“", "„", '"')


def open_structure(text: str) -> list[str]:
    """What is still open at the end of a text: a stack of fences, tags, brackets, quotations, list items and rows of tables.

    An item is open while nothing follows its mark, a row until its last bar; a new line closes both. A closing mark
    takes down what was opened after its partner, but never across a fence.
    """
    stack: list[str] = []

    def down(what: str) -> None:
        del stack[len(stack) - 1 - stack[::-1].index(what) :]

    body = "\n" + text if "\n" in text else text
    end = len(body.rstrip())
    for m in _STRUCTURE.finditer(body):
        t = m[0]
        if t == "```":
            if "```" in stack:
                down(t)
            else:
                stack.append(t)
        elif "```" in stack:
            continue
        elif t[0] == "\n":
            if stack and stack[-1] in ("item", "row"):
                stack.pop()
            kind = t.strip()
            if kind == "|":
                row = body[m.end() : body.find("\n", m.end()) if "\n" in body[m.end() :] else len(body)].rstrip()
                if not row.endswith("|"):
                    stack.append("row")
            elif kind and m.end() >= end and body.count("\n", 0, end) > 1:
                stack.append("item")
        elif m[1]:
            tag = m[1].lower()
            if t.endswith("/>") or tag in _VOID:
                continue
            if not t.startswith("</"):
                stack.append(f"<{tag}>")
            elif f"<{tag}>" in stack:
                down(f"<{tag}>")
        elif t in ('"', "”", "“"):
            if t == "“" and "„" not in stack:
                stack.append(t)
            elif t == '"' and not any(q in stack for q in _QUOTES):
                stack.append(t)
            else:
                held = [q for q in stack if q in _QUOTES]
                if held:
                    down(held[-1])
        elif t in _PAIRS:
            if _PAIRS[t] in stack:
                down(_PAIRS[t])
        else:
            stack.append(t)
    return stack


# Verb forms and words that open a clause which needs a verb.
_AUX = frozenset("is was are were be been being am has have had do does did may might can could shall should will would must ought cannot".split())
_OPENS = frozenset("because although while whereas unless if when whenever until though".split())
_TAIL = re.compile(r"[\"'”’»)\]*_`]+$")
_CLAUSE = re.compile(r"(?<=[.!?])[\"'”’»)\]]*\s+")
_UNSEEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad\u00a0"


def is_truncated(answer: str, c: Counts) -> bool:
    """Whether an answer breaks off before its sentence is complete. Lacking only the final stop is not enough."""
    text = answer.rstrip().rstrip(_UNSEEN).rstrip()
    if not text:
        return False
    bare = _TAIL.sub("", text).rstrip()
    if bare.endswith("“") and "„" in bare:  # it closes
        bare = _TAIL.sub("", bare[:-1]).rstrip()
    last = bare[-1:] or text[-1:]
    held = open_structure(text) if "\n" in text or "```" in text or last not in ".!?" else []
    if "item" in held or "```" in held:
        return True
    if text.endswith("```"):
        return False
    if last == "…" or bare.endswith("...") or bare.endswith(". . ."):
        return not re.search(r"\betc[.…]*$", bare)
    if last in ".!?":
        return False
    if last in ",;:-—–¬=([{«“&/" or unicodedata.category(last) == "Pd":
        return True
    if held:
        if not text.isascii() and any(q in held for q in (*_QUOTES, "«")):  # a closing mark may be wrongly decoded
            held = open_structure(undo(text))
        # a line or row without its own end says nothing of a text that never had ends of lines
        if any(x != "row" for x in held) or text.count("|\n") > 0:
            return True
    token = text.split()[-1]
    if len(token) <= 9 and token not in "”’»" and not token.isascii() and not re.search(r"[0-9A-Za-zÀ-ɏ]", token.replace("â", "")):
        return True  # a dash, perhaps wrongly decoded
    words = [w.lower() for w in _LETTERS.findall(bare)]
    if not words:
        return False
    sentence = _CLAUSE.split(bare)[-1]
    own = [w.lower() for w in _LETTERS.findall(sentence)]
    several = len(words) > len(own)
    w = name(words[-1])
    if not last.isalpha():
        return False
    single = len(own) <= 3 and not several
    if w not in c.known:
        if w in c.prefixes:
            return True
        # an unknown word that is no beginning of a known one: a name, or part of a name that is cut
        return False if single else not _has_verb(own[:-1], c)
    share = c.final.get(w, 0.0)
    if share < 0.015 and not (single and len(own) == 1):
        return True
    if single:
        return False
    if share < 0.06 and w in c.prefixes and len(w) <= 4:
        return True
    clause = own
    for i in range(len(own) - 1, -1, -1):
        if own[i] in _OPENS or (own[i] == "that" and i and own[i - 1] == "so"):
            clause = own[i + 1 :]
            break
    if any(x in c.odds and c.odds[x].argmax() > 0 and c.odds[x].max() > 1 for x in own[:8]) and not any(x in _OWN["en"] for x in own):
        return False  # verbs of other languages aren't known
    return not _has_verb(clause, c)


def _has_verb(words: list[str], c: Counts) -> bool:
    # an unknown word, say a misread one, may be the verb
    return any(w in _AUX or w in c.verbs or (w.endswith("ed") and len(w) > 4) or (len(w) > 3 and w not in c.known) for w in words)


# ---- refusal ----------------------------------------------------------------------------------

# Who speaks, how it is denied, which act of speech, about what: declining is composed of these.
_GRAMMAR = """
person = i | we
be = am | are | is | was | were | be
modal = can | could | will | would | may | might | shall | should | must | do
negated = <modal> not | cannot | can't | couldn't | won't | wouldn't | don't | shan't | mustn't | shouldn't
able = able | free | allowed | permitted | willing | inclined | disposed | prepared | authorised | authorized
unable = not <able> to | unable to | forbidden to | unwilling to | not at liberty to | not feel at liberty to | not in a position to | not feel able to
wish = wish | care | intend | propose | choose | want | mean | undertake | attempt | presume | be
averse = prefer not to | would prefer not to | had rather not | would rather not | rather not | beg not to | hope not to
refusing = decline | declining | refuse | refusing | declined | forbear | abstain from
denial = <negated> | <modal>? <be>? <unable> | <be>? <unable> | <negated> feel at liberty to | <negated> feel able to | <averse> | <modal>? <refusing> to | have to <refusing> to | beg to <refusing> to
denial = <negated> <wish> to | <negated> <wish> | regret that <person> <negated> | <be> afraid <person> <negated> | regret <person> <negated> | <be> sorry <person> <negated>

act = answer | answering | reply | respond | responding | discuss | discussing | comment | speak | speaking | talk | assist | assisting | oblige | advise | disclose | share | comply | engage | continue
act = fulfil | fulfill | provide | providing | enter | enter upon | enter into | go into | weigh in | dwell | open | tell you | help you | help with | help in | say more | say anything | give you | give <saying> | offer <saying>
act = undertake to <act> | attempt <saying> | attempt to <act> | make <saying> | a reply | an answer
saying = an opinion | an answer | a reply | advice | any <word-given> | an <word-given> | a <word-given> | no <word-given>
word-given = answer | reply | response | comment | information | opinion | help | advice | view | explanation
topic = request | question | inquiry | enquiry | query | matter | subject | topic | point
pointing = this | that | the | your | such | to | a | any
passive = answered | fulfilled | granted | met | given | discussed | satisfied | complied with | offered | made | provided | entered upon | entered into

refusal = <person> ~2 <denial> ~1 <act>
refusal = <person> <modal>? have? to? <refusing> ~2 <pointing> <topic> | <person> <modal>? <refusing> ~2 <act> | <person> <modal>? <refusing> ~2 <pointing> <act>
refusal = <topic> ~4 <negated> be <passive> | <topic> ~4 <negated> be <passive> here
refusal = no <word-given> <modal> be <passive> | <person> <modal> <giving> no <word-given>
giving = offer | give | make | provide | return | venture
refusal = <person> have no <word-given> ~6 <denial> | <person> have no <word-given> ~6 <modal>
refusal = <asking> excuse <me> | <asking> to? be excused | beg to be excused | beg leave to be excused
asking = must | please | pray | kindly | beg | ask | beg you to | ask you to | i ask | would ask
me = me | us
refusal = not be <seemly> for <me> to ~1 <act> | not be <seemly> for <me> to ~1 say
seemly = proper | fitting | right | appropriate | suitable | becoming | seemly
refusal = <turning> to? me? <other> <topic> | <turning> to <me> <other> <topic> | <turning> me? something else | <turning> me? anything else | consult another book
turning = put | ask | choose | try | consider
other = some other | any other | another
refusal = beyond what <person> <reach> ~1 <act> | beyond what <person> <reach> ~1 <telling>
reach = may | can | could | <be> able to | <be> <able> to
telling = say | tell | give
refusal = not <thing> <relating>? <person> <reach> ~1 <act> | not <thing> <relating>? <person> <wishing> ~1 <act> | not <thing> <relating>? <person> <reach> ~1 <telling>
wishing = wish to | care to | will | choose to
thing = something | a thing | a <topic>
relating = that | which | about which | of which | on which | upon which
refusal = <topic> <upon> which <person> ~1 <modal>? <not-saying>
upon = upon | on | about | of
not-saying = had? rather not | prefer not | would rather not | would prefer not | cannot | not | decline | refuse
refusal = <topic> is one <relating>? <person> <denial>
refusal = as an ai | as a language model | as a large language model | as an artificial | as an assistant

# French
je = je | j | nous
parler = répond* | parl* | discut* | aid* | trait* | comment* | fourni*
refusal = <je> ~3 ne ~4 <parler> | <je> ~3 n ~4 <parler> | <je> ~1 <regretter> ~6 <parler> | <je> ~1 <regretter> ~6 réponse
regretter = regrette | refuse | regrettons | refusons
refusal = ne m'est pas <permis> ~2 <dire> | ne m est pas <permis> ~2 <dire> | ne nous est pas <permis> ~2 <dire> | n est pas <permis> ~2 <dire>
permis = permis | possible
dire = répondre | parler | discuter | traiter | dire | en parler | d'en parler | d en parler
refusal = veuillez m'excuser | veuillez m excuser | je vous prie de m'excuser | je vous prie de m excuser
refusal = <préférer> ne pas ~1 <dire>
préférer = préfère | préférerais | aime mieux
# German
wer = ich | wir | mir
nicht = nicht | keine | leider
sagen = beantworten | antworten | antwort | helfen | sprechen | äußern | auskunft | reden | besprechen | erörtern | dienen | geben
refusal = <wer> ~6 <nicht> ~5 <sagen> | <wer> ~6 <nicht> <sagen> | <müssen-ich> ~7 <ablehnen>
müssen-ich = ich <müssen> | wir <müssen>
müssen = muss | möchte | lehne | müssen | bedaure | bedauere | bitte
ablehnen = ablehnen | ab | entschuldigen | antworten | verzichten | können | sprechen | sagen | schweigen
refusal = <nicht-dürfen> ~4 <sagen> | <nicht-dürfen> ~4 sagen
nicht-dürfen = nicht gestattet | nicht erlaubt | keineswegs gestattet | keineswegs erlaubt
# Spanish
hablar = responder | contestar | ayudar* | hablar | opinar | tratar | dar | ofrecer
refusal = no <poder> ~3 <hablar> | <lamentar> ~5 <hablar> | <lamentar> ~5 <excusar>
poder = puedo | podemos | debo | quiero | deseo | me es permitido | me está permitido | me es posible | voy a
lamentar = lamento | siento | prefiero | me niego | ruego | rehúso
excusar = excusen | excuse | disculpen | disculpe | respuesta
# Italian
parlare = rispondere | aiutar* | parlar* | trattar* | discutere | dare | fornire
refusal = non <potere> ~3 <parlare> | <dispiacere> ~5 <parlare> | <dispiacere> ~5 <scusare>
potere = posso | possiamo | devo | voglio | desidero | mi è permesso | mi è possibile | mi è consentito | intendo
dispiacere = mi dispiace | preferisco | mi rifiuto | rifiuto | vi prego | la prego
scusare = scusar* | risposta
"""
_COMMON = "i we is are a an the this that to of not no be do can will may must have me us on in it you as ne n non le la en que nicht ich wir m une point matter made given was were could would should for any one some which here es mi est return say tell go make been has had such what who how".split()
_REFUSES = Grammar(_GRAMMAR, "refusal", _COMMON)
_SENTENCE = re.compile(r"[^.!?;]+[.!?;]*")
_TERMS = re.compile(r"[^\W_]+(?:'[^\W_]+)*")
# Words by which a sentence addresses whoever asks, and by which one turns to an answer after all.
_ADDRESS = frozenset("you your sir madam question inquiry enquiry request asked ask sorry regret thank thanks unfortunately pardon".split())
_TURNS = frozenset("but yet however nevertheless nonetheless still though although".split())
_CONTINUES = re.compile(r",? (?:but|yet|for|because|though|although|however|that) ")
STATEMENT = 7  # words from which a sentence that addresses nobody says something


def is_refusal(answer: str, question: str | None = None) -> bool:
    """Whether an answer declines to answer, with reasons or without.

    It doesn't if it says something first, if the clause that declines goes on to answer, or if a later sentence turns to
    an answer after all.
    """
    low = answer.lower().replace("’", "'").replace("ſ", "s")
    if not _REFUSES.may_hold(_TERMS.findall(low)):
        return False
    if question:
        q = question.strip().lower().replace("’", "'").rstrip("?.! ")
        if len(q) > 8:
            low = low.replace(q, " that ")
    hit = False
    for m in _SENTENCE.finditer(low):
        words = _TERMS.findall(m[0])
        if not words:
            continue
        r = _REFUSES.find(words) if _REFUSES.may_hold(words) else None
        if r and not _goes_on(m[0], words[r[1] :]):
            hit = True
        elif hit and words[0] in _TURNS and len(words) > 4:
            return False
        elif not hit and len(words) >= STATEMENT and _ADDRESS.isdisjoint(words):
            return False
    return hit


def _goes_on(sentence: str, rest: list[str]) -> bool:
    """Whether a sentence that declines goes on to answer after its comma."""
    if "," not in sentence or len(rest) < 3:
        return False
    tail = sentence[sentence.find(",") :]
    return bool(_CONTINUES.match(tail)) and len(tail.split()) > 4 and _REFUSES.find(_TERMS.findall(tail)) is None


# ---- copy -------------------------------------------------------------------------------------

MIN_TILE = 2  # words
# Words by which a copy is introduced.
_FRAME = frozenset("you ask asked asks the question is was a an answer ans q to that says repeat repeated question. vous demandez la frage lautet sie fragen usted pregunta domanda chiede réponse antwort respuesta risposta".split())


def tiles(a: list[str], b: list[str], shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest common run of unmarked words first, until none has ``shortest`` words. (place in a, place in b, length)."""
    used_a, used_b = [False] * len(a), [False] * len(b)
    out = []
    places: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        places.setdefault(w, []).append(j)
    while True:
        best = (0, 0, 0)
        for i, w in enumerate(a):
            if used_a[i] or len(a) - i <= best[2]:
                continue
            for j in places.get(w, ()):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < shortest:
            return out
        i, j, n = best
        out.append(best)
        used_a[i : i + n] = [True] * n
        used_b[j : j + n] = [True] * n


def is_copy(question: str, answer: str) -> bool:
    """Whether an answer gives its question back, perhaps several times or in a frame, and adds nothing."""
    x, y = (set(t.lower().split()) for t in (question, answer))
    if len(x & y) * 3 < len(y):
        return False
    q, a = (re.sub(r"[^\w ]+", " ", x.lower().replace("ſ", "s")).split() for x in (question, answer))
    if len(q) < 3 or len(a) < min(3, len(q)):
        return False
    own = set(q)
    if sum(w not in own and w not in _FRAME and len(w) > 2 for w in a) > max(1, 0.12 * len(q)) + len(q):
        return False  # more new words than any frame has
    left = list(a)
    covered = 0
    while len(left) >= 0.5 * len(q):  # the question may be given back more than once
        found = tiles(left, q)
        n = sum(t[2] for t in found)
        if n < 0.5 * len(q):
            break
        covered += n
        gone = {i + k for i, _, m in found for k in range(m)}
        left = [w for i, w in enumerate(left) if i not in gone]
    if covered < 0.6 * len(q):
        return False
    rest = Counter(left) - Counter(w for w in q if w not in a)
    added = [w for w, n in rest.items() for _ in range(n) if w not in _FRAME and w not in q and len(w) > 2]
    return len(added) <= max(1, 0.12 * len(q))


# ---- language ---------------------------------------------------------------------------------

_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")
_PLAIN_ENGLISH = frozenset("the of and is had with which that this from were been".split())
MARGIN = 3.0  # nats by which each side must speak for its language


def scores(text: str, c: Counts) -> tuple[np.ndarray, int]:
    """(log odds by language summed over a text's distinct words, how many words have them)."""
    place, table = c.rows()
    at = [i for w in names(set(_LETTERS.findall(text.lower()))) if (i := place.get(w)) is not None]
    return table[at].sum(axis=0), len(at)


_NOT_LATIN = re.compile(r"[^\W\d_A-Za-zÀ-ɏ]")


def script(text: str) -> str | None:
    """The script of most letters; null without letters."""
    others = _NOT_LATIN.findall(text)
    if len(others) * 2 <= len(_LETTERS.findall(text)) and text:
        return "LATIN" if _LATIN.search(text) else None
    n: Counter = Counter(unicodedata.name(c, "?").split()[0] for c in others)
    n["LATIN"] = len(_LATIN.findall(text))
    return n.most_common(1)[0][0] if sum(n.values()) else None


def is_other_language(question: str, answer: str, c: Counts) -> bool:
    """Whether most of an answer is in another language than its question; short and doubtful texts are not."""
    x, y = (set(t.lower().split()) for t in (question, answer))
    if x & _PLAIN_ENGLISH and len(y & _PLAIN_ENGLISH) * 8 >= len(y):
        return False  # both speak English plainly
    if not question.isascii() or not answer.isascii():
        x, y = script(question), script(answer)
        if x and y and x != y and len(_LETTERS.findall(answer)) >= 2:
            return True
    a, n = scores(answer, c)
    q, m = scores(question, c)
    if n < 3 or m < 2:
        return False
    la, lq = int(a.argmax()), int(q.argmax())
    return la != lq and a[la] - a[lq] >= MARGIN and q[lq] - q[la] >= MARGIN


# ---- all ----------------------------------------------------------------------------------------

DEFECTS = ("empty", "truncated", "refusal", "copy", "language")


def defects(question: str | None, answer: str | None, c: Counts) -> list[str]:
    if is_empty(answer):
        return ["empty"]
    assert answer is not None
    out = []
    copy = bool(question) and is_copy(question or "", answer)
    refusal = is_refusal(answer, question)
    if copy:
        out.append("copy")
    elif refusal:
        out.append("refusal")
    if not copy and not refusal and is_truncated(answer, c):
        out.append("truncated")
    if question and is_other_language(question, answer, c):
        out.append("language")
    return out


def find(records: DataFrame, counts: Counts) -> DataFrame:
    """(src, rec_id, defect) of each defect in the records' answers, one row per record and defect and delivery.

    ``records`` are (src, rec_id, turns). A null question makes no defect, nor do null or empty turns lists
    and system turns; null answers are ``empty``, as are user turns without an answer. Texts of any
    length are read whole; repeated records repeat their rows (the queries take distinct ones).
    """
    shipped = records.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        c = shipped.value
        for b in batches:
            srcs, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            offsets, roles, contents = _flat(b)
            rows: list[tuple[str, str, str]] = []
            for i, (src, rid) in enumerate(zip(srcs, ids, strict=True)):
                turns = [{"role": roles[j], "content": contents[j]} for j in range(offsets[i], offsets[i + 1])]
                found = {d for q, a, answered in exchanges(turns) for d in (defects(q, a, c) if answered else ["empty"])}
                rows += [(src, rid, d) for d in DEFECTS if d in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["src", "rec_id", "defect"])

    return records.select("src", "rec_id", "turns").mapInArrow(run, "src string, rec_id string, defect string")
