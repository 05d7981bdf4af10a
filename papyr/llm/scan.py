"""Repairing text that was read from scanned pages.

Words are counted over all texts. Skip-gram vectors are learned from the pair counts of all texts, for trusted
words and for rare ones alike. A rare word is linked to a frequent one if a plausible confusion of glyphs leads
from one to the other and their vectors lie near; in its place it is corrected if the prior (how much more
frequent the true word is, less a cost for each confusion) and the evidence (vectors of the words around)
together speak for it. Then page furniture is taken out (see :mod:`papyr.llm.furniture`), words broken by hyphens
are joined, and lines flow into paragraphs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyr.llm import encoding, furniture, quality
from papyr.llm.rest import Asker, filter_of
from papyr.llm.tokens import LONG, names
from papyr.session import materialise

# What a reader of scanned pages takes for what. From the misread glyphs to the true ones.
CONFUSIONS = (
    ("f", "s"), ("c", "e"), ("e", "c"), ("f", "t"), ("u", "n"), ("n", "u"), ("l", "i"), ("i", "l"), ("cl", "d"), ("d", "cl"), ("b", "h"), ("h", "b"),
    ("rn", "m"), ("m", "rn"), ("q", "g"), ("g", "q"), ("vv", "w"), ("li", "h"), ("ii", "n"), ("ii", "u"), ("tl", "d"), ("t", "f"), ("nn", "m"), ("in", "m"), ("iu", "m"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("3", "e"), ("4", "a"), ("7", "t"), ("$", "s"), ("@", "a"), ("€", "e"),
)
# Letters of other scripts that look like Latin ones, old forms and joined letters.
LOOKALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ո": "n", "в": "b", "к": "k", "м": "m", "т": "t", "н": "h",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "ι": "i", "κ": "k", "ε": "e", "χ": "x", "γ": "y", "η": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ſ": "s", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
}
_LOOK = str.maketrans(LOOKALIKE)
_LATIN = re.compile(r"[A-Za-z]")
_OUTER = ".,;:!?\"'()[]{}«»“”‘’—–-¬=…*_"
_ONE_SIGN = frozenset("0123456789!|$@€")

FREQUENT = 1e-5  # share of all words from which a word is trusted; so no more than 100,000 are, and the lexicon
RARE_WORDS = 60_000  # most frequent rare words that every task holds; the others are asked for (see papyr.llm.rest)
OFTEN = 12  # times as frequent as its misreading must the true word be
EDITS = 2  # confusions in one word (those of long s besides)

# ---- counting -----------------------------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) in lower case without outer punctuation, over all texts; very long words by digest."""

    def run(batches):
        for b in batches:
            n: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    n.update([w.strip(_OUTER) for w in t.lower().split()])
            del n[""]
            keys = list(n)
            yield pa.RecordBatch.from_arrays([pa.array(names(keys), pa.string()), pa.array([n[w] for w in keys], pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _wrong, _right in CONFUSIONS:
    _BY_FIRST.setdefault(_wrong[0], []).append((_wrong, _right))


class Glyphs:
    """Finds the words that others may be misreadings of, by walking the words' beginnings; exact at any length."""

    def __init__(self, words):
        self.words = words
        self.starts = {w[:i] for w in words for i in range(1, len(w) + 1)}

    def readings(self, w: str, edits: int = EDITS) -> dict[str, int]:
        """The words that ``w`` may be a misreading of, with the number of confusions, those of the fewest only. Any number of long s counts as one."""
        found: dict[str, int] = {}
        starts, words, n = self.starts, self.words, len(w)
        # (place, what is read so far, confusions, whether a long s is among them)
        front = [(0, "", 0, False)]
        seen = set()
        while front:
            i, head, k, old = front.pop()
            if i == n:
                if k and head in words and found.get(head, edits + 1) > k:
                    found[head] = k
                continue
            c = w[i]
            nxt = head + c
            if nxt in starts:
                front.append((i + 1, nxt, k, old))
            for wrong, right in _BY_FIRST.get(c, ()):
                s = wrong == "f" and right == "s"
                more = k + (0 if s and old else 1)
                if more <= edits and w.startswith(wrong, i):
                    nxt = head + right
                    state = (i + len(wrong), nxt, more, old or s)
                    if nxt in starts and state not in seen:
                        seen.add(state)
                        front.append(state)
        least = min(found.values(), default=0)
        return {x: k for x, k in found.items() if k == least and x != w}


@dataclass
class Words:
    """Trusted words with their counts, and vectors of trusted and rare words: bounded tables, and what they leave out."""

    counts: dict[str, int]
    ids: dict[str, int]  # the vectors' rows: trusted words first, by frequency
    inner: np.ndarray  # of a word
    outer: np.ndarray  # of a word as context of others
    rare: dict[str, int] = field(default_factory=dict)  # counts of words with vectors that aren't trusted
    forms: furniture.Forms = furniture.Forms()
    rest: DataFrame | None = None  # (key, n, vector): other rare words after ``w``, and furniture's keys
    bits: bytes | None = None  # the filter over its keys


def trust(rows: list[tuple[str, int]], total: int, lexicon: set[str]) -> dict[str, int]:
    """The words that are right: of the lexicon, or frequent and no plausible misreading of a far more frequent one."""
    counts = dict(rows)
    floor = max(6.0, FREQUENT * total)
    frequent = {w: n for w, n in counts.items() if (n >= floor or (w in lexicon and n > 1)) and w.replace("'", "").replace("’", "").replace("-", "").isalpha() and _plain(w)}
    glyphs = Glyphs(frequent)
    out = {}
    for w, n in frequent.items():
        if w not in lexicon:
            best = max((frequent[v] for v in glyphs.readings(w, 1)), default=0)
            if best >= OFTEN * n:
                continue
        out[w] = n
    for w in lexicon:
        out.setdefault(w, 1)
    return out


def _plain(w: str) -> bool:
    """No letters that only look like Latin ones among Latin letters, and no old forms."""
    t = w.translate(_LOOK)
    return t == w or not _LATIN.search(w)


# ---- skip-gram vectors ----------------------------------------------------------------------------

VECTOR_WORDS = 6000  # most frequent trusted words, on which the contexts' vectors are trained
CONTEXTS = 512  # most frequent words that count as contexts
WINDOW = 2
DIMENSIONS = 40
NEGATIVES = 5
STEPS = 30
TIE = 1.0  # pull of a folded vector towards nothing, in pairs
GROUP = 500  # words folded in together


def count_pairs(texts: DataFrame, ids: dict[str, int], contexts: int = CONTEXTS) -> DataFrame:
    """(pair bigint, n): skip-gram pairs word * contexts + context within WINDOW words, over all texts."""
    shipped = texts.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        get = shipped.value.get
        at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            gap = [-1] * WINDOW  # keeps neighbouring texts apart
            flat: list[int] = []
            for t in b.column(0).to_pylist():
                if t:
                    flat += [get(w.strip(_OUTER), -1) for w in t.lower().split()]
                    flat += gap
            x = np.array(flat, np.int64)
            codes = []
            for d in range(1, WINDOW + 1):
                for w, c in ((x[:-d], x[d:]), (x[d:], x[:-d])):
                    ok = (w >= 0) & (c >= 0) & (c < contexts)
                    codes.append(w[ok] * contexts + c[ok])
            new, k = np.unique(np.concatenate(codes), return_counts=True)
            both, where = np.unique(np.concatenate([at, new]), return_inverse=True)
            at, n = both, np.bincount(where, np.concatenate([n, k]), len(both)).astype(np.int64)
            if len(at) > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["pair", "n"])
                at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["pair", "n"])

    return texts.select("text").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def skip_gram(pairs: np.ndarray, n: np.ndarray, words: int, contexts: int, seed: int = 0, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of words and contexts that maximise the skip-gram objective with negative sampling, in expectation over all pairs.

    sum over pairs of n(w, c) log s(w.c) + k n(w) n(c) / N log s(-w.c), by Adam from a seeded start.
    """
    rng = np.random.default_rng(seed)
    x = np.zeros((words, contexts), np.float32)
    x[pairs // contexts, pairs % contexts] = n
    total = max(float(x.sum()), 1.0)
    neg = NEGATIVES * x.sum(1, keepdims=True) * x.sum(0, keepdims=True) / total
    weight = 1.0 / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1.0))  # frequent words don't drown the rest
    w = rng.standard_normal((words, DIMENSIONS)).astype(np.float32) * 0.1
    c = rng.standard_normal((contexts, DIMENSIONS)).astype(np.float32) * 0.1
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, c)]
    for step in range(1, steps + 1):
        s = 1 / (1 + np.exp(-np.clip(w @ c.T, -12, 12)))
        g = (x * (1 - s) - neg * s) * weight
        grads = (g @ c, g.T @ w)
        for p, gr, (m, v) in zip((w, c), grads, state, strict=True):
            m *= 0.8
            m += 0.2 * gr
            v *= 0.95
            v += 0.05 * gr * gr
            p += 0.15 * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-8)
    return w, c


def fold_in(x: np.ndarray, outer: np.ndarray, share: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Vectors of words from their pair counts (words x contexts), the contexts' vectors held fast: the same objective, tied to nothing where counts are few.

    ``share`` is each context's share of all pairs.
    """
    total = x.sum(1, keepdims=True)
    neg = NEGATIVES * total * share
    weight = 1.0 / (total + TIE)
    w = np.zeros((len(x), outer.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        s = 1 / (1 + np.exp(-np.clip(w @ outer.T, -12, 12)))
        g = ((x * (1 - s) - neg * s) @ outer - TIE * w) * weight
        m = 0.8 * m + 0.2 * g
        v = 0.95 * v + 0.05 * g * g
        w += 0.15 * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-8)
    return w


def learn(texts: DataFrame, lexicon: DataFrame | None = None) -> Words:
    """Trusted words, vectors and furniture of all texts (column ``text``); ``lexicon`` (word) is a bounded table of right words."""
    known = {r["word"].lower() for r in lexicon.where(F.col("word").isNotNull()).select("word").collect()} if lexicon is not None else set()
    counted = materialise(count_words(texts), "words")
    every = counted.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    several = counted.where((F.col("n") > 1) & ~F.startswith("word", F.lit("\x00")))
    listed = texts.sparkSession.createDataFrame(pa.table({"word": pa.array(sorted(known), pa.string()), "listed": pa.array([True] * len(known), pa.bool_())}))
    rows = several.join(F.broadcast(listed), "word", "left").where((F.col("n") >= FREQUENT * every) & (F.col("n") >= 6) | F.col("listed")).select("word", "n").collect()
    trusted = trust([(r["word"], r["n"]) for r in rows], every, known)
    words = fit(trusted, materialise(rare_words(several, trusted), "rare"), texts)
    forms = furniture.learn(texts)
    words.forms = replace(forms, rest=None)
    if forms.rest is not None:
        more = forms.rest.select("key", F.lit(1).cast("bigint").alias("n"), F.lit(None).cast("binary").alias("vector"))
        words.rest = more if words.rest is None else words.rest.unionByName(more)
    if words.rest is not None:
        words.bits = filter_of(words.rest)
    return words


def rare_words(counted: DataFrame, trusted: dict[str, int]) -> DataFrame:
    """The rows of (word, n) whose words aren't trusted and may be misreadings of trusted ones."""
    shipped = counted.sparkSession.sparkContext.broadcast(trusted)

    def run(batches):
        glyphs = Glyphs(shipped.value)
        for b in batches:
            yield b.filter(pa.array([w not in glyphs.words and bool(glyphs.readings(w.translate(_LOOK))) for w in b.column(0).to_pylist()], pa.bool_()))

    return counted.select("word", "n").mapInArrow(run, "word string, n bigint")


def fit(trusted: dict[str, int], counted: DataFrame, texts: DataFrame) -> Words:
    """Vectors: of the most frequent trusted words and of the contexts by training, of all other trusted and of the rare words ``counted`` by folding them in, in the cluster."""
    order = sorted(trusted, key=lambda w: (-trusted[w], w))
    got = counted.orderBy(F.col("n").desc(), "word").limit(RARE_WORDS + 1).collect()
    rare = {r["word"]: r["n"] for r in got[:RARE_WORDS]}
    ids = {w: i for i, w in enumerate([*order, *rare])}
    contexts = min(CONTEXTS, max(len(order), 1))
    trained = min(VECTOR_WORDS, len(order))
    pairs = materialise(count_pairs(texts, ids, contexts), "pairs")
    bound = max(trained, 1) * contexts
    table = pairs.where(F.col("pair") < bound).toArrow()
    at, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    w, c = skip_gram(at, n, max(trained, 1), contexts)
    inner = np.zeros((max(len(ids), 1), DIMENSIONS), np.float32)
    inner[: len(w)] = w
    share = np.bincount(at % contexts, n, contexts).astype(np.float32) / max(n.sum(), 1)
    if len(ids) > trained:
        for r in _folded(pairs.where(F.col("pair") >= bound), c, share, contexts).collect():
            inner[r["word"]] = np.frombuffer(r["vector"], np.float32)
    words = Words(trusted, ids, inner, c, rare)
    if len(got) > RARE_WORDS:
        last = got[RARE_WORDS]
        left = counted.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") >= last["word"])))
        words.rest = materialise(_folded_rest(left, texts, dict(zip(order[:contexts], range(contexts), strict=False)), c, share), "rare-rest")
    return words


def _folded_rest(left: DataFrame, texts: DataFrame, contexts: dict[str, int], outer: np.ndarray, share: np.ndarray) -> DataFrame:
    """(key, n, vector) of the rare words ``left`` (word, n): the same vectors as others have, from pairs counted by word."""
    spark = texts.sparkSession
    shipped, bits = spark.sparkContext.broadcast(contexts), spark.sparkContext.broadcast(filter_of(left.select(F.concat(F.lit("w"), "word").alias("key"))))

    def count(batches):
        get, may_hold = shipped.value.get, Asker(bits.value).may_hold
        n: Counter = Counter()

        def rows():
            keys = list(n)
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.int32()), pa.array([n[k] for k in keys], pa.int64())], names=["word", "context", "pairs"])

        for b in batches:
            for t in b.column(0).to_pylist():
                tokens = [w.strip(_OUTER) for w in t.lower().split()] if t else []
                at = [get(w, -1) for w in tokens]
                for i, w in enumerate(tokens):
                    if at[i] < 0 and len(w) <= LONG and may_hold("w" + w):
                        n.update([(w, at[j]) for j in range(max(0, i - WINDOW), min(len(at), i + WINDOW + 1)) if j != i and at[j] >= 0])
                if len(n) > 500_000:
                    yield rows()
                    n.clear()
        yield rows()

    def run(t: pa.Table) -> pa.Table:
        counts = dict(zip(t.column("word").to_pylist(), t.column("n").to_pylist(), strict=True))
        row = {w: i for i, w in enumerate(counts)}
        x = np.zeros((len(row), len(outer)), np.float32)
        for w, c, n in zip(*[t.column(k).to_pylist() for k in ("word", "context", "pairs")], strict=True):
            if c is not None:
                x[row[w], c] = n
        return pa.table({"key": pa.array(["w" + w for w in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64()), "vector": pa.array([v.tobytes() for v in fold_in(x, outer, share)], pa.binary())})

    pairs = texts.select("text").mapInArrow(count, "word string, context int, pairs bigint").groupBy("word", "context").agg(F.sum("pairs").alias("pairs"))
    groups = left.count() // GROUP + 1
    return left.join(pairs, "word", "left").withColumn("g", F.pmod(F.xxhash64("word"), F.lit(groups))).groupBy("g").applyInArrow(lambda t: run(t), "key string, n bigint, vector binary")


def _folded(pairs: DataFrame, outer: np.ndarray, share: np.ndarray, contexts: int) -> DataFrame:
    """(word int, vector binary) of each word of ``pairs``; GROUP words and their contexts, a bounded number of rows, are folded in at a time."""

    def run(t: pa.Table) -> pa.Table:
        at, n = t.column("pair").to_numpy(), t.column("n").to_numpy()
        words, row = np.unique(at // contexts, return_inverse=True)
        x = np.zeros((len(words), contexts), np.float32)
        x[row, at % contexts] = n
        return pa.table({"word": pa.array(words, pa.int32()), "vector": pa.array([v.tobytes() for v in fold_in(x, outer, share)], pa.binary())})

    return pairs.withColumn("g", F.floor(F.col("pair") / (contexts * GROUP))).groupBy("g").applyInArrow(lambda t: run(t), "word int, vector binary")


# ---- misread words --------------------------------------------------------------------------------

EDIT = 2.3  # nats a confusion costs
LINK = 3.0  # nats a rare word's vector gives or takes, by its cosine to the true word's
FAR = 0.25  # cosine at which it gives nothing
LOG_NEGATIVES = float(np.log(NEGATIVES))  # a vector's product with a context's is their log odds less this
FEW = 4.0  # occurrences at which a rare word's vector counts half
CLIP = 2.5  # nats one word beside may give or take
PRIOR = 1.0  # nats by which a rare word is right as it stands, before anything is known of it
ALONE = 6.0  # nats of prior that suffice where no word around has a vector


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-6)


class Reader:
    """Corrects words with the trusted ones; remembers what it has seen."""

    def __init__(self, words: Words, limit: int = 300_000):
        self.words, self.limit = words, limit
        self.glyphs = Glyphs(words.counts)
        self.cache: dict[str, tuple[str, dict[str, int]]] = {}
        self.fine: set[str] = set()  # tokens as they stand in texts that need no second look
        self.usual = 1e-3 * sum(words.counts.values())
        self.contexts = len(words.outer)
        self.links: dict[tuple[int, int], float] = {}  # no more than rare words and their readings
        self.unit = _unit(words.inner)
        self.middle = words.outer.mean(axis=0)
        self.rest = Asker(words.bits) if words.bits else None
        self.forms = words.forms.asking(self.rest) if self.rest else words.forms

    def status(self, token: str) -> tuple[str, dict[str, int]]:
        """(kind, readings) of a token in lower case without outer marks: ``ok``, ``sure`` (signs or letters no word holds), ``maybe``, or ``odd`` (unknown, without reading)."""
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) > self.limit:
                self.cache.clear()
            got = self.cache[token] = self._status(token)
        return got

    def _status(self, t: str) -> tuple[str, dict[str, int]]:
        counts = self.words.counts
        if t in counts or len(t) < 2 or t.isdigit():
            return "ok", {}
        if not _LATIN.search(t):
            return "ok", {}
        plain = t.translate(_LOOK)
        if plain != t:
            latin = sum(map(str.isascii, t))
            if plain in counts:
                return "sure", {plain: 1}
            r = self.glyphs.readings(plain)
            if r:
                return "sure", r
            return ("sure", {plain: 1}) if latin * 2 > len(t) and plain.isascii() and plain.isalpha() else ("odd", {})
        if any(c in _ONE_SIGN for c in t):
            letters = sum(map(str.isalpha, t))
            if letters * 2 <= len(t) and len(t) > 3 or letters == 0 or (t[0].isdigit() and letters <= 3):
                return "ok", {}
            r = {w: n for w, n in self.glyphs.readings(t).items() if counts[w] > 2 and len(w) > 2}
            return ("sure", r) if r else ("odd", {})
        if not t.isalpha():
            return "ok", {}
        r = {w: n for w, n in self.glyphs.readings(t).items() if len(w) > 1}
        return ("maybe", r) if r else ("odd", {})

    def best(self, token: str, r: dict[str, int], around: list[int]) -> tuple[str, float]:
        """The reading of a token that prior and evidence speak for most, and the nats by which they do so against the token as it stands.

        Prior: the reading's count against the token's, less EDIT for each confusion. Evidence: how near the
        token's vector lies to the reading's, where the token has one, else how near the words around do; and
        the log odds of each word around the reading. Without any word around that has a vector the prior must reach ALONE.
        """
        w = self.words
        near = [i for i in around if 0 <= i < self.contexts]
        own = w.ids.get(token)
        seen = w.rare.get(token, 0)
        if own is None and self.rest and (got := self.rest.get("w" + token)):
            seen, own = got[0], _unit(np.frombuffer(got[1], np.float32))
        place = w.outer[near] if near else None
        top, value = "", -1e9
        for word, edits in r.items():
            score = math.log(w.counts.get(word, 0) + 1) - math.log(seen + 1) - EDIT * edits - PRIOR
            i = w.ids.get(word)
            if i is None or place is None:
                score -= ALONE
            else:
                score += sum([min(max(x + LOG_NEGATIVES, -CLIP), CLIP) for x in (place @ w.inner[i]).tolist()])
                if own is not None:  # the rare word's own vector, from all its places
                    score += seen / (seen + FEW) * self._link(own, i)
                else:  # from this place alone
                    v = place.sum(axis=0) - len(near) * self.middle
                    score += LINK * (float(v @ self.unit[i]) / max(math.sqrt(float(v @ v)), 1e-6) - FAR) / (1 - FAR) / (1 + FEW)
            if score > value:
                top, value = word, score
        return top, value

    def _link(self, own: int | np.ndarray, other: int) -> float:
        """The nats that a rare word's vector, by its row or as it is, gives for another word."""
        if not isinstance(own, int):
            return LINK * (float(own @ self.unit[other]) - FAR) / (1 - FAR)
        got = self.links.get((own, other))
        if got is None:
            got = self.links[own, other] = LINK * (float(self.unit[own] @ self.unit[other]) - FAR) / (1 - FAR)
        return got

    def misread(self, tokens: list[str]) -> list[tuple[int, str]]:
        """(place, reading) of the misread ones among a text's words."""
        fine = self.fine
        fresh = [i for i, t in enumerate(tokens) if t not in fine]
        if not fresh:
            return []
        odd = []
        for i in fresh:
            t = tokens[i].strip(_OUTER).lower()
            if not t or self.status(t)[0] in ("ok", "odd"):
                if len(fine) > self.limit:
                    fine.clear()
                fine.add(tokens[i])
            elif tokens[i][-1] not in "-¬=" and (i == 0 or tokens[i - 1][-1] not in "-¬="):  # half a word is no word
                odd.append(i)
        if not odd:
            return []
        status, low, ids = self.status, [t.strip(_OUTER).lower() for t in tokens], self.words.ids
        out = []
        for i in odd:
            kind, r = status(low[i])
            prev = low[i - 1] if i else ""
            if kind == "sure" and low[i][0].isdigit() and (prev[:1].isdigit() or "£" in tokens[i - 1] or "£" in tokens[i]):
                continue
            around = [ids.get(low[j], -1) for j in range(max(0, i - WINDOW), min(len(low), i + WINDOW + 1)) if j != i]
            word, nats = self.best(low[i], r, around)
            # a short word has too many neighbours, unless it is one of the most usual
            if kind == "sure" or (nats > 0 and len(low[i]) > 2 and (len(low[i]) > 3 or self.words.counts.get(word, 0) > self.usual)):
                out.append((i, word))
        return out



# ---- hyphens, lines ---------------------------------------------------------------------------------

# What a text must hold for the pattern below to be worth trying.
_MARKS = re.compile(r"[-¬=‐](?:\s|$)|¬")
_BREAK = re.compile(r"(?<![^\W_])([^\W\d_]+)([-¬=‐])([ \t]*\n\s*|[ \t]+|(?<=¬))([^\W\d_]+)")


@dataclass
class Findings:
    furniture: int = 0
    breaks: int = 0
    misread: int = 0
    text: str | None = None

    @property
    def any(self) -> bool:
        return bool(self.furniture or self.breaks or self.misread)


def joined(text: str, reader: Reader) -> tuple[str, int]:
    """(text, number of broken words joined). Hyphens that belong where they stand stay."""
    if not _MARKS.search(text):
        return text, 0
    n = 0
    counts = reader.words.counts

    def join(m: re.Match) -> str:
        nonlocal n
        a, mark, gap, b = m.groups()
        word = (a + b).lower()
        x, y = a.lower(), b.lower()
        right = word in counts or reader.status(word)[0] in ("sure", "maybe")
        if mark in "¬" or (mark == "=" and len(a) > 1 and b[0].islower()):
            pass
        elif right and not (x in counts and y in counts and f"{x}-{y}" in counts):
            pass
        elif b[0].islower() and x not in counts and y not in counts and "\n" in gap:
            pass
        elif b[0].islower() and x not in counts and y not in counts and reader.status(x)[0] == "odd" and reader.status(y)[0] == "odd":
            pass
        else:
            return m[0]
        n += 1
        return a + b

    return _BREAK.sub(join, text), n


_PARAGRAPH = re.compile(r"\n\s*\n")
_BLANKS = re.compile(r"[ \t\f\v]+")  # no-break spaces belong to the text, or are half of a misread letter


def reflow(text: str) -> str:
    """Lines joined into paragraphs. A line break stays where the line is no running text: before an item, a number, or after a short line that ends."""
    out = []
    for p in _PARAGRAPH.split(text.replace("\r\n", "\n").replace("\r", "\n")):
        lines = [_BLANKS.sub(" ", x).strip(" ") for x in p.split("\n") if x.strip()]
        if not lines:
            continue
        width = max(map(len, lines))
        cur = lines[0]
        for x in lines[1:]:
            ends = cur[-1:] in ".!?:;”\"" and len(cur.rsplit("\n", 1)[-1]) < 0.7 * width
            item = re.match(r"(?:[-*•+–]|\(?\d+[.)]|[a-z][.)])\s", x)
            cur += "\n" + x if ends or item else " " + x
        out.append(cur)
    return "\n\n".join(out)


UNIT = 4.8  # words in a unit below which a text is a list or table
KNOWN = 0.45  # share of a text's words that must be known, or readable, for it not to be junk


def is_prose(text: str, reader: Reader) -> bool:
    units = quality.units(text)
    n = sum(units)
    if not n or sum(u * u for u in units) < UNIT * n and n > 6:
        return False
    tokens = [t.strip(_OUTER).lower() for t in text.split()]
    tokens = [t for t in tokens if len(t) > 1]
    good = sum(t in reader.words.counts or reader.status(t)[0] in ("sure", "maybe") for t in tokens)
    return good >= KNOWN * max(len(tokens), 1)


def unwrapped(text: str, plain: str, reader: Reader) -> str:
    """A text without findings: prose in continuous paragraphs, all else as it is. A few words in lines are a list, unless they are a sentence that goes on over a line's end."""
    if "\n" not in text and "\r" not in text:
        return text
    new = reflow(text)
    if new == text or not is_prose(plain, reader):
        return text
    if sum(quality.units(plain)) <= 6 and not (new.endswith((".", "!", "?", "”", '"')) and any(x.lstrip()[:1].islower() for x in text.splitlines()[1:])):
        return text
    return new


def repair(text: str | None, reader: Reader) -> Findings:
    """What is found in a text, and the text in continuous paragraphs. Lists, tables and junk stay as they are."""
    if not text or text.isspace():
        return Findings(text=text)
    plain = text if text.isascii() else encoding.undo(text)
    body, pieces = furniture.without_furniture(plain, reader.forms)
    body, breaks = joined(body, reader)
    tokens = body.split()
    fixes = reader.misread(tokens)
    if not (pieces or breaks or fixes):
        return Findings(text=unwrapped(text, plain, reader))
    if not is_prose(plain, reader):
        return Findings(text=text)
    if fixes:
        body = _with_fixes(body, tokens, fixes)
    return Findings(pieces, breaks, len(fixes), reflow(body))


def _with_fixes(body: str, tokens: list[str], fixes: list[tuple[int, str]]) -> str:
    new = dict(fixes)
    out, at = [], 0
    for i, t in enumerate(tokens):
        j = body.index(t, at)
        out.append(body[at:j])
        if i in new:
            core = t.strip(_OUTER)
            word = new[i]
            if core.isupper() and len(core) > 1:
                word = word.upper()
            elif core[:1].isupper():
                word = word[:1].upper() + word[1:]
            k = t.index(core) if core else 0
            out.append(t[:k] + word + t[k + len(core) :])
        else:
            out.append(t)
        at = j + len(t)
    return "".join([*out, body[at:]])


def repair_columns(records: DataFrame, keep: list[str], texts: list[str], words: Words) -> DataFrame:
    """(keep..., field, furniture, breaks, misread, text): a row for each non-null text of each record.

    Null texts have no row; empty and blank ones, lists, tables and junk come back as they were with
    counts 0, prose without findings in continuous paragraphs with counts 0. Texts are read whole, row by row, without shuffle; repeated records repeat their rows.
    """
    if words.rest is not None:
        return _repair_asking(records, keep, texts, words)
    shipped = records.sparkSession.sparkContext.broadcast(words)
    schema = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        reader = Reader(shipped.value)
        for b in batches:
            for j, name in enumerate(texts):
                col = b.column(len(keep) + j)
                got = [repair(t, reader) for t in col.to_pylist()]
                out = pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array([name] * len(got)), *_columns(got)], names=[*keep, "field", *_FOUND])
                yield out.filter(col.is_valid())

    return records.select(*keep, *[F.col(t).cast("string").alias(t) for t in texts]).mapInArrow(run, f"{schema}, field string, furniture int, breaks int, misread int, text string")


_FOUND = ("furniture", "breaks", "misread", "text")


def _columns(got: list[Findings]) -> list[pa.Array]:
    return [*[pa.array([getattr(g, k) for g in got], pa.int32()) for k in _FOUND[:3]], pa.array([g.text for g in got], pa.string())]


def _repair_asking(records: DataFrame, keep: list[str], texts: list[str], words: Words) -> DataFrame:
    """The same where the tables that tasks hold leave out keys: texts that ask for some of these are read again with the answers, until none asks for more.

    Only such texts are shuffled. Each round answers at least one more key of a text, so the rounds end.
    """
    shipped = records.sparkSession.sparkContext.broadcast(replace(words, rest=None))
    schema = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keep)
    table = words.rest.where(~F.startswith("key", F.lit("s")))
    width = len(keep)

    def run(batches):
        reader = Reader(shipped.value)
        for b in batches:
            got, asked = [], []
            for t, given in zip(b.column(width + 1).to_pylist(), b.column(width + 2).to_pylist(), strict=True):
                answers = {r["key"]: (r["n"], r["vector"]) if r["n"] is not None else None for r in given or ()}
                reader.rest.begin(answers)
                found = repair(t, reader)
                open_ = reader.rest.asked
                got.append(Findings(text=t) if open_ else found)
                asked.append([*answers, *sorted(open_)] if open_ else None)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(width + 1)], *_columns(got), pa.array(asked, pa.list_(pa.string()))], names=[*keep, "field", *_FOUND, "_asked"])

    def read(rows: DataFrame) -> DataFrame:
        return materialise(rows.mapInArrow(run, f"{schema}, field string, furniture int, breaks int, misread int, text string, _asked array<string>"), "repaired")

    fields = F.explode(F.array(*[F.struct(F.lit(t).alias("field"), F.col(t).cast("string").alias("text")) for t in texts]))
    none = F.lit(None).cast("array<struct<key:string,n:bigint,vector:binary>>").alias("_given")
    now = read(records.select(*keep, fields.alias("_f")).where(F.col("_f.text").isNotNull()).select(*keep, "_f.field", "_f.text", none))
    out = now.where(F.col("_asked").isNull()).drop("_asked")
    while not (left := now.where(F.col("_asked").isNotNull())).isEmpty():
        left = left.withColumn("_digest", F.sha2("text", 256))
        given = left.select("_digest", F.explode("_asked").alias("key")).distinct().join(table, "key", "left").groupBy("_digest").agg(F.collect_list(F.struct("key", "n", "vector")).alias("_given"))
        now = read(left.join(given, "_digest").select(*keep, "field", "text", "_given"))
        out = out.unionByName(now.where(F.col("_asked").isNull()).drop("_asked"))
    return out
