"""Languages of documents and of their segments by a linear-chain conditional random field.

Each word is an observation with affix, character n-gram and lexicon features; the states are the
languages. Lexicon counts cover all labelled documents. The weights are fitted on a bounded sample of
labelled documents whose sentences are joined into code-switched sequences, so that the transitions
are learned together with the emissions. Forward-backward gives every word of every document its
posterior, from which sentences, segments and documents take language and confidence.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyr.llm.tokens import LONG, name, names
from papyr.session import materialise

LANGUAGES = ("en", "fr", "de", "es", "it")
# Codes and English names by which a label may name a language.
NAMES = {
    "en": "en", "eng": "en", "english": "en", "fr": "fr", "fre": "fr", "fra": "fr", "french": "fr", "de": "de", "ger": "de", "deu": "de", "german": "de",
    "es": "es", "spa": "es", "spanish": "es", "it": "it", "ita": "it", "italian": "it",
}
_LABEL = re.compile(r"\s*([A-Za-z]{2,})(?:[-_][A-Za-z0-9]+)*\s*$")

LEXICON_WORDS = 60_000  # most frequent words that have lexicon features
KNOWN_SHARE = 1e-5  # of all words, from which a word counts as known
SAMPLE_PER_LANGUAGE = 500  # labelled documents the weights are fitted on
SENTENCES_PER_DOCUMENT = 40  # of each, in seeded order from all of it
SHORTEST, LONGEST_SENTENCE = 3, 60  # words of a sentence to learn from
SEQUENCES = 2500  # code-switched training sequences made from them
FEATURES = 1 << 15
STEPS = 70  # of the optimiser

_WORD = re.compile(r"(?<![\d_])[^\W\d_]+(?![\d_])")
# a word: letters before an apostrophe, two letters or more, or a vowel that is a word by itself
_UNIT_WORD = re.compile(r"(?<![\w])[^\W\d_](?=['’])|(?<![\d_])[^\W\d_]{2,}(?![\d_])|(?<![\w'’])[aàáeèéioòóuyAÀÁEÈÉIOÒÓUY](?![\w.])")
# the end of a sentence, a blank line, a line's end
_END = re.compile(r"(?=[.!?…\n])(?:([.!?…]+[\"'”’»)\]]*(?=\s|$)|[!?])|(\n[^\S\n]*\n\s*)|(\n))")
_SENTENCE_END = re.compile(r"(?=[.!?…\n])(?:[.!?…]+[\"'”’»)\]]*(?=\s|$)|[!?]|\n[^\S\n]*\n\s*)")
_RUNNING = re.compile(r"(?<![\w])[a-zß-öø-ÿœ]{4,}(?![\w])")  # a word of running text


def lowered(text: str) -> str:
    """The text in lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def label_language(label: str | None) -> str | None:
    """The language a label names, by code with or without region or by English name, in any case; null if none of ours."""
    m = _LABEL.match(label or "")
    return NAMES.get(m[1].lower()) if m else None


# ---- lexicon over all documents -------------------------------------------------------------


def count_words(documents: DataFrame, prior: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(word, lang, n) in lower case, over all documents; lang is the label's language or ``-``, and n the number of documents.

    With ``prior`` (lexicon features of a first count, a bounded table) lang is instead what the words of
    each sentence, and of its document, speak for, so that wrong labels no longer count, and n the number of words.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(prior) if prior is not None else None

    def run(batches):
        feats = shipped.value if shipped is not None else None
        index = {w: i for i, w in enumerate(feats or ())}
        table = np.array(list(feats.values()), np.float32)[:, :-1] if feats else np.zeros((0, len(LANGUAGES)), np.float32)
        for b in batches:
            n: Counter = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                if feats is None:
                    k = label_language(lang) or "-"
                    n.update((w, k) for w in names(set(_WORD.findall(text.lower()))) if len(w) > 1)
                    continue
                units = sentences(text)
                for u, k in zip(units, vote(units, index, table), strict=True):
                    for w in names(u):
                        n[w, LANGUAGES[k]] += 1
            keys = list(n)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([n[k] for k in keys], pa.int64())], names=["word", "lang", "n"])

    return documents.select("lang", "text").mapInArrow(run, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def vote(units: list[list[str]], index: dict[str, int], table: np.ndarray) -> list[int]:
    """The language of each sentence by its words, each once, and less so by the document's. ``table`` has the features of the words of ``index``."""
    if not units:
        return []
    get = index.get
    own = [[i for w in set(u) if (i := get(w if len(w) <= LONG else name(w))) is not None] for u in units]
    flat = [i for u in own for i in u]
    if not flat:
        return [0] * len(units)
    sums = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[flat], axis=0, dtype=np.float64)])
    ends = np.cumsum([len(u) for u in own])
    whole = table[list(set(flat))].sum(axis=0)
    return (sums[ends] - sums[ends - [len(u) for u in own]] + 0.3 * whole).argmax(axis=1).tolist()


def lexicon(counts: DataFrame, size: int = LEXICON_WORDS) -> tuple[dict[str, np.ndarray], np.ndarray, int]:
    """(word -> counts by language, with the unlabelled last; totals; all words) of the ``size`` most frequent words."""
    by_word = counts.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(F.lit(0))).alias(f"n_{k}") for k in LANGUAGES])
    total = counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()
    totals = np.array([next((r["n"] for r in total if r["lang"] == k), 0) for k in LANGUAGES], float)
    every = sum(r["n"] for r in total)
    rows = by_word.orderBy(F.col("n").desc(), "word").limit(size).collect()
    return {r["word"]: np.array([*[r[f"n_{k}"] for k in LANGUAGES], r["n"]], float) for r in rows}, totals, every


def label_sample(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 0) -> list[tuple[str, list[str]]]:
    """(language, words): sentences of a seeded sample of labelled documents, at most ``per_language`` documents each.

    The documents are read whole, in the cluster; of each its SENTENCES_PER_DOCUMENT first in seeded order come back.
    """
    label = F.regexp_extract(F.lower(F.trim("lang")), r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    code = F.lit(None).cast("string")
    for label_name, k in NAMES.items():
        code = F.when(label == label_name, F.lit(k)).otherwise(code)
    rows = documents.select(code.alias("k"), F.col("text").alias("t"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")).where(F.col("k").isNotNull() & (F.length("t") > 40))
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("h", "t"))).where(F.col("r") <= per_language)

    def run(batches):
        for b in batches:
            ks: list[str] = []
            out: list[list[str]] = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fit_ = [s for s in sentences(t) if SHORTEST <= len(s) <= LONGEST_SENTENCE]
                own = sorted(fit_, key=lambda s: zlib.crc32(f"{seed} {' '.join(s)}".encode("utf-8", "surrogatepass")))[:SENTENCES_PER_DOCUMENT]
                ks += [k] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["k", "s"])

    return sorted((r["k"], list(r["s"])) for r in best.select("k", "t").mapInArrow(run, "k string, s array<string>").collect())


# ---- features -------------------------------------------------------------------------------


def word_features(word: str) -> list[int]:
    """Hashed affixes and character n-grams of a word in lower case."""
    w = f"<{word}>"
    names = [f"p{i}{word[:i]}" for i in (1, 2, 3) if len(word) >= i] + [f"s{i}{word[-i:]}" for i in (1, 2, 3, 4) if len(word) >= i]
    names += [f"g{w[i : i + 2]}" for i in range(len(w) - 1)] + [f"g{w[i : i + 3]}" for i in range(len(w) - 2)] + [f"w{word}"] * (len(word) <= 4)
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & (FEATURES - 1) for x in dict.fromkeys(names)]


@dataclass
class Model:
    weights: np.ndarray  # FEATURES x languages
    lex_weights: np.ndarray  # lexicon features x languages
    transitions: np.ndarray  # log potentials, languages x languages
    start: np.ndarray
    lexicon: dict[str, np.ndarray]  # word -> lexicon features
    known: frozenset[str]

    def __post_init__(self):
        self._forget()

    def _forget(self) -> None:
        self._ids: dict[str, int] = {}
        self._rows = np.zeros((1024, len(LANGUAGES)), np.float32)
        self._flags = np.zeros((1024, 2), bool)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_ids", "_rows", "_flags")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _add(self, word: str) -> int:
        i = self._ids[word] = len(self._ids)
        if i == len(self._rows):
            self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
            self._flags = np.concatenate([self._flags, np.zeros_like(self._flags)])
        x = self.weights[word_features(word)].sum(axis=0)
        own = name(word)
        f = self.lexicon.get(own)
        if f is not None:
            x = x + f @ self.lex_weights
        self._rows[i] = x - x.max()
        self._flags[i] = own in self.known, len(word) > 1
        return i

    def _places(self, words: list[str]) -> list[int]:
        """The rows of words; those of words seen before are remembered, some 200,000 of them."""
        if len(self._ids) > 200_000:
            self._forget()
        get = self._ids.get
        return [i if (i := get(w)) is not None else self._add(w) for w in words]

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log potentials of words by language, one row a word; whether each is known, and whether it has more than a letter)."""
        at = self._places(words)
        return self._rows[at], self._flags[at]


def lexicon_features(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """A word's counts by language against what its frequency makes one expect, rare words drawn to nothing, and a constant that says the lexicon has it."""
    expected = counts[:-1].sum() * totals / max(totals.sum(), 1.0)
    odds = np.log((counts[:-1] + 2.0) / (expected + 2.0))
    return np.concatenate([np.clip(odds - odds.mean(), -6, 6) / 2, [1.0]])


# ---- forward-backward -----------------------------------------------------------------------


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Posteriors (B, T, K) of padded sequences, and with ``pairs`` the summed posteriors of neighbours and the log-likelihood's norm."""
    b, t, k = emissions.shape
    psi, a = np.exp(emissions), np.exp(transitions)
    alpha, scale = np.zeros((b, t, k)), np.ones((b, t))
    cur = psi[:, 0] * np.exp(start)
    for i in range(t):
        if i:
            cur = (alpha[:, i - 1] @ a) * psi[:, i]
        s = cur.sum(axis=1, keepdims=True)
        alpha[:, i], scale[:, i] = cur / s, s[:, 0]
    beta = np.ones((b, k))
    post = np.empty((b, t, k))
    both = np.zeros((k, k))
    for i in range(t - 1, -1, -1):
        inside = (i < lengths)[:, None]
        if i < t - 1:
            nxt = (i + 1 < lengths)[:, None]
            m = psi[:, i + 1] * beta / scale[:, i + 1][:, None]
            if pairs:
                left = np.where(nxt, alpha[:, i], 0)
                both += a * (left.T @ np.where(nxt, m, 0))
            beta = np.where(nxt, m @ a.T, 1.0)
        g = alpha[:, i] * beta
        post[:, i] = np.where(inside, g / np.maximum(g.sum(axis=1, keepdims=True), 1e-300), 0)
    if not pairs:
        return post
    mask = np.arange(t)[None] < lengths[:, None]
    return post, both, float((np.log(np.maximum(scale, 1e-300)) * mask).sum())


# ---- training -------------------------------------------------------------------------------


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence or paragraph, in lower case."""
    low = lowered(text)
    out = []
    at = 0
    for m in _SENTENCE_END.finditer(low):
        # the end is read along with the words, as a vowel before a stop is no word
        out.append(_UNIT_WORD.findall(low, at, m.end()))
        at = m.end()
    out.append(_UNIT_WORD.findall(low, at))
    return [u for u in out if u]


def fit(sample: list[tuple[str, list[str]]], lex: dict[str, np.ndarray], totals: np.ndarray, every: int, seed: int = 0, steps: int = STEPS) -> Model:
    """Fit weights and transitions by conditional likelihood with Adam; half of the words' lexicon features are hidden while fitting, so that affixes learn too."""
    rng = np.random.default_rng(seed)
    k = len(LANGUAGES)
    feats = {w: lexicon_features(c, totals) for w, c in lex.items()}
    known = frozenset(w for w, c in lex.items() if c[-1] >= max(2.0, KNOWN_SHARE * every) and len(w) > 1)
    # sentences whose words, by the lexicon, speak for their document's label; wrong labels fall out here
    bank: list[list[list[str]]] = [[] for _ in LANGUAGES]
    for lang, s in sample:
        y = LANGUAGES.index(lang)
        seen = [feats[w][:-1] for w in names(s) if w in feats]
        if len(seen) >= 0.5 * len(s) and int(np.sum(seen, axis=0).argmax()) == y:
            bank[y].append(s)
    present = [y for y in range(k) if bank[y]]
    model = Model(np.zeros((FEATURES, k)), np.zeros((k + 1, k)), np.zeros((k, k)), np.zeros(k), feats, known)
    if not present:
        return model
    seqs: list[tuple[list[str], list[int]]] = []
    for _ in range(SEQUENCES):
        words: list[str] = []
        ys: list[int] = []
        y = int(rng.choice(present))
        for _ in range(int(rng.integers(1, 6))):
            s = bank[y][int(rng.integers(len(bank[y])))]
            words += s
            ys += [y] * len(s)
            if rng.random() < 0.3:
                y = int(rng.choice(present))
        seqs.append((words[:120], ys[:120]))
    types: dict[str, int] = {}
    ids = [np.array([types.setdefault(w, len(types)) for w in ws]) for ws, _ in seqs]
    lengths = np.array([len(x) for x in ids])
    t = int(lengths.max())
    tok = np.zeros((len(ids), t), int)
    gold = np.zeros((len(ids), t), int)
    mask = np.arange(t)[None] < lengths[:, None]
    for i, (x, (_, ys)) in enumerate(zip(ids, seqs, strict=True)):
        tok[i, : len(x)], gold[i, : len(x)] = x, ys
    flat = [word_features(w) for w in types]
    owner = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
    cols = np.concatenate(flat)
    begins = np.concatenate([[0], np.cumsum([len(f) for f in flat])[:-1]])
    lexm = np.array([feats.get(name(w), np.zeros(k + 1)) for w in types])
    gold_one = np.eye(k)[gold] * mask[:, :, None]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    gold_start = np.bincount(gold[:, 0], minlength=k).astype(float)
    n = mask.sum()
    params = [model.weights, model.lex_weights, model.transitions, model.start]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rows = tok[mask]
    for step in range(1, steps + 1):
        shown = lexm * (rng.random(len(types)) < 0.5)[:, None]
        e_type = np.add.reduceat(model.weights[cols], begins, axis=0) + shown @ model.lex_weights
        post, both, _ = forward_backward(e_type[tok] - e_type[tok].max(axis=2, keepdims=True), lengths, model.transitions, model.start, pairs=True)
        diff = (gold_one - post)[mask]
        g_type = np.stack([np.bincount(rows, diff[:, j], len(types)) for j in range(k)], axis=1)
        grads = [np.stack([np.bincount(cols, g_type[owner, j], FEATURES) for j in range(k)], axis=1), shown.T @ g_type, gold_pairs - both, gold_start - post[:, 0].sum(axis=0)]
        for p, g, (m, v) in zip(params, grads, moment, strict=True):
            g = g / n * 1000 - 0.02 * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p += 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return Model(model.weights.astype(np.float32), model.lex_weights.astype(np.float32), model.transitions, model.start, feats, known)


def learn(documents: DataFrame) -> Model:
    """The model of a corpus: lexicon over all documents, counted by label and again by sentence, weights from the bounded sample of labelled ones."""
    lex, totals, _ = lexicon(materialise(count_words(documents), "words"))
    first = {w: lexicon_features(c, totals) for w, c in lex.items() if c[-1] > 2}
    lex, totals, every = lexicon(materialise(count_words(documents, first), "words"))
    return fit(label_sample(documents), lex, totals, every)


# ---- reading documents ----------------------------------------------------------------------

BATCH_WORDS = 200_000  # words of padded sequences held at once


def posteriors(words: list[list[str]], model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index, posteriors of its words, their flags) of each sequence, by length, in padded batches of bounded size."""
    order = sorted((i for i in range(len(words)) if words[i]), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        size = 1
        while at + size < len(order) and size < 512 and (size + 1) * len(words[order[at + size]]) <= BATCH_WORDS:
            size += 1
        part = order[at : at + size]
        at += size
        lengths = np.array([len(words[i]) for i in part])
        e = np.zeros((len(part), int(lengths.max()), len(LANGUAGES)), np.float32)
        flags = []
        for r, i in enumerate(part):
            e[r, : lengths[r]], f = model.emissions(words[i])
            flags.append(f)
        post = forward_backward(e, lengths, model.transitions, model.start)
        for r, i in enumerate(part):
            yield i, post[r, : lengths[r]], flags[r]


@dataclass
class Span:
    start: int  # first character
    end: int
    first: int  # first word
    last: int  # after the last word
    whole: bool  # a sentence: it ends like one, and isn't a heading all in capitals or capitalised words


AROUND = 2000  # characters around a place whose capitals count


def capitals_around(text: str) -> Callable[[int, int], bool]:
    """Whether most letters around a place (from, to) are capitals: in the whole text if it is short."""

    def most(part: str) -> bool:
        return sum(map(str.isupper, part)) > 0.5 * sum(map(str.isalpha, part))

    if len(text) <= AROUND:
        always: list[bool] = []

        def everywhere(a: int, b: int) -> bool:
            if not always:
                always.append(most(text))
            return always[0]

        return everywhere
    # letters and capitals before each character
    upper, alpha = (np.cumsum(np.fromiter(map(f, text), np.int32, len(text))) for f in (str.isupper, str.isalpha))

    def around(a: int, b: int) -> bool:
        i = min(max((a + b - AROUND) // 2, 0), len(text) - AROUND)
        j = i + AROUND - 1
        return bool(upper[j] - (upper[i - 1] if i else 0) > 0.5 * (alpha[j] - (alpha[i - 1] if i else 0)))

    return around


def spans(text: str) -> tuple[list[str], list[Span]]:
    """The words of a text in lower case, and its sentences; a line is a unit of its own where no sentence goes on over its end."""
    words: list[str] = []
    out: list[Span] = []
    low = lowered(text)
    capitals = capitals_around(text)
    first, begin, end = 0, -1, 0  # of the open unit: its first word, first and last character
    running = False  # whether the unit has a word of running text; where all is in capitals, each has
    line_words = at = 0

    def close(upto: int, whole: bool) -> None:
        nonlocal first, begin, running
        if len(words) > first:
            out.append(Span(begin, upto, first, len(words), whole and (running or capitals(begin, upto))))
        first, begin, running = len(words), -1, False

    def take(upto: int) -> None:
        """The words up to a place."""
        nonlocal begin, end, running, line_words
        found = _UNIT_WORD.findall(low, at, upto)
        if found:
            if begin < 0:
                begin = _UNIT_WORD.search(low, at, upto).start()  # type: ignore[union-attr]
            end = low.rindex(found[-1], at, upto) + len(found[-1])
            running = running or _RUNNING.search(text, at, upto) is not None
            words.extend(found)
            line_words += len(found)

    for m in _END.finditer(text):
        take(m.end())
        if m[1]:
            close(m.end(), True)
        elif m[2]:
            close(end, False)
            line_words = 0
        else:
            nxt = text[m.end() : m.end() + 1]
            # short lines, or lines before a mark or a number, are rows of a list; a sentence goes on in words
            if line_words < 4 and not nxt.islower() or not (nxt.isalpha() or nxt in "“\"'«¿¡(—"):
                close(end, False)
            line_words = 0
        at = m.end()
    take(len(text))
    close(end, False)
    return words, out


MIN_WORDS = 3  # of a full sentence
MIN_KNOWN = 0.5  # share of a unit's words that must be known for it to be language
MIN_CONFIDENCE = 0.85  # of a full sentence
LIST_SHARE = 0.2  # of a list's words that makes a language one of the list's


def read(words: list[str], units: list[Span], post: np.ndarray, flags: np.ndarray) -> tuple[dict[str, float], list[tuple[Span, str, float]]]:
    """(language -> confidence of the document, (unit, language, confidence) of its units of language).

    A language is the document's if it has a full sentence; where most words stand outside of
    sentences (lists, tables) if it has a fair share of the words.
    """
    if not words:
        return {}, []
    known, real = flags[:, 0], flags[:, 1]
    # units follow one another without gaps, so their sums are those between their first words
    starts = np.fromiter((u.first for u in units), np.int64, len(units))
    n_real, n_known = np.add.reduceat(real.astype(np.int64), starts), np.add.reduceat(known.astype(np.int64), starts)
    # unknown words count by their affixes, but less; so do elided articles and the like
    weight = np.where(known, 1.0, 0.3)
    p = np.add.reduceat(post * weight[:, None], starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
    best = p.argmax(axis=1)
    good = (n_real > 0) & (n_known >= MIN_KNOWN * n_real)
    found: list[tuple[Span, str, float]] = []
    full: list[bool] = []  # whether each is a full sentence
    in_sentences = 0
    sure = p.max(axis=1).tolist()
    for i in np.flatnonzero(good).tolist():
        u = units[i]
        found.append((u, LANGUAGES[best[i]], sure[i]))
        full.append(u.whole and bool(n_real[i] >= MIN_WORDS))
        if full[-1]:
            in_sentences += u.last - u.first
    share: Counter = Counter()
    for u, lang, _ in found:
        share[lang] += u.last - u.first
    total = sum(share.values())
    if not total or total < 0.3 * real.sum():
        return {}, []
    prose = in_sentences >= 0.4 * total
    langs: dict[str, list[float]] = {}
    for (_, lang, conf), sentence in zip(found, full, strict=True):
        if prose and not (sentence and conf >= MIN_CONFIDENCE):
            continue
        if not prose and share[lang] < max(2, LIST_SHARE * total):
            continue
        langs.setdefault(lang, []).append(conf)
    if not langs:
        top = share.most_common(1)[0][0]
        langs[top] = [c for _, k, c in found if k == top]
    return {k: float(np.mean(v)) for k, v in langs.items()}, found


def _analyse(texts: list[str | None], model: Model) -> list[tuple[dict[str, float], list[tuple[Span, str, float]]]]:
    parsed = [spans(t) if t else ([], []) for t in texts]
    out: list[tuple[dict[str, float], list]] = [({}, [])] * len(texts)
    for i, post, flags in posteriors([w for w, _ in parsed], model):
        out[i] = read(*parsed[i], post, flags)
    return out


def languages(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, label, lang, confidence, cased boolean): a row for each language a document holds.

    ``label`` is what its own label names, if anything; ``cased`` says that the document isn't wholly in
    that language. Null, empty and blank texts and those without words of a language have no row.
    """
    sc = documents.sparkSession.sparkContext
    shipped = sc.broadcast(model)

    def run(batches):
        m = shipped.value
        for b in batches:
            ids, labels, texts = (b.column(i).to_pylist() for i in range(3))
            rows = []
            for at in _slices(texts):
                for i, (langs, _) in zip(at, _analyse([texts[i] for i in at], m), strict=True):
                    own = label_language(labels[i])
                    rows += [(ids[i], own, k, c, set(langs) != {own}) for k, c in langs.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.float64()), pa.array([r[4] for r in rows], pa.bool_())],
                names=["doc_id", "label", "lang", "confidence", "cased"],
            )

    return documents.select("doc_id", "lang", "text").mapInArrow(run, "doc_id bigint, label string, lang string, confidence double, cased boolean")


def segments(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, segment, start_char, end_char, lang, confidence): neighbouring units of one language, joined; numbered from 0."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shipped.value
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for at in _slices(texts):
                for i, (langs, units) in zip(at, _analyse([texts[i] for i in at], m), strict=True):
                    joined: list[list] = []
                    for u, k, c in units:
                        if k not in langs:
                            continue
                        n = u.last - u.first
                        if joined and joined[-1][2] == k:
                            joined[-1][1], joined[-1][3], joined[-1][4] = u.end, joined[-1][3] + c * n, joined[-1][4] + n
                        else:
                            joined.append([u.start, u.end, k, c * n, n])
                    rows += [(ids[i], s, x[0], x[1], x[2], x[3] / x[4]) for s, x in enumerate(joined)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["doc_id", "segment", "start_char", "end_char", "lang", "confidence"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, segment int, start_char int, end_char int, lang string, confidence double")


def _slices(texts: list[str | None], chars: int = 3_000_000) -> Iterator[list[int]]:
    """Indexes in runs of some three million characters, which bounds a worker's memory."""
    part: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t or "")
        if size > chars:
            yield part
            part, size = [], 0
    if part:
        yield part
