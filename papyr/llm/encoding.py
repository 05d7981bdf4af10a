"""Finding and repairing text that was decoded with the wrong character encoding.

A fragment (a word with characters beyond ASCII, and its neighbours) has many candidate readings:
each chain of "write these characters as bytes of W, read the bytes as R" that applies to it. The
description length of a reading is what zstandard needs to code it with the dictionary of a
language, plus the cost of the chain. The shortest reading wins; on a tie the text stays as it is.
The dictionaries hold the corpus' own frequent fragments, counted over all rows, without those
that a chain turns into more frequent ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyr.session import materialise

# The encodings in which bytes are commonly misread.
MISREAD_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859-2")
# Single-byte encodings in which the bytes were really written.
WRITTEN_IN = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250")

STEP_BITS = 5.0  # cost of a step of a chain: to name one of about 32
DICTIONARY_BYTES = 160_000  # of each language's dictionary
CONTEXTS = 4  # surroundings of a word that may enter it
WORDS = 60_000  # most frequent words that are told from misreadings of others
FRAGMENTS_PER_LANGUAGE = 20_000  # most frequent fragments that may enter it
LEVEL = 19
SEARCH_LOG = 12  # matches are looked for deep in a dictionary, as short fragments have few to win by
DEEPEST = 3  # layers of misreading undone

_WORD = re.compile(r"[^ \t\n\r\f\v]*[^\x00-\x7f][^ \t\n\r\f\v]*")
# a word's context: the nearest 24 characters of its neighbours, a window that moves along
_BEFORE, _AFTER = re.compile(r"([^ \t\n\r\f\v]{1,24})[ \t\n\r\f\v]+$"), re.compile(r"[ \t\n\r\f\v]+([^ \t\n\r\f\v]{1,24})")
_DIGITS = re.compile(r"[0-9]+")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
LOST = "\ufffd"
OUTER = ".,;:!?\"'()"
WINDOW = 64  # characters from which a run without blanks is cut into pieces
_PIECE = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+[^A-Za-z0-9\x80-\U0010ffff]*|[^A-Za-z0-9\x80-\U0010ffff]+")
_ALTERNATE = re.compile(r"[\x00-\x7f]{1,32}|[^\x00-\x7f]+")
ODD_BITS = 12.0  # of a character that no text should hold
KNOWN_BITS = 12.0  # saved by a word that the dictionaries hold whole, where the word as it stands is none and looks like none
# Letters of other scripts that may be misread Latin ones rather than wrongly decoded bytes.
_LOOKALIKE = re.compile("[авекмнорстухіјѕһԁАВЕКМНОРСТХЅІЈαβεικνορτυχγηΑΒΕΖΗΙΚΜΝΟΡΤΥΧ]")


def _byte_table(encoding: str) -> dict[int, str]:
    """From a character to the Latin-1 character of its byte in ``encoding``; bytes without meaning stand for themselves."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(ord(c), chr(b))
    return table


_TO_BYTES = {e: _byte_table(e) for e in {*MISREAD_AS, *WRITTEN_IN}}


class _OrNul(dict):
    """A table for ``str.translate`` that gives NUL for what it doesn't hold."""

    def __missing__(self, key: int) -> str:
        return "\x00"


_BYTES_OR_NUL = {e: _OrNul({**{i: chr(i) for i in range(0x80)}, **t}) for e, t in _TO_BYTES.items()}
_FROM_BYTES = {e: {ord(v): chr(k) for k, v in t.items()} for e, t in _TO_BYTES.items()}


def _as_bytes(word: str, encoding: str) -> str:
    """The word with each character replaced by its byte's, or by NUL where it has none."""
    return word.translate(_BYTES_OR_NUL[encoding])


def _undo_utf8(word: str, misread: str) -> str | None:
    """The word with each complete UTF-8 sequence that was misread given back; null if it has none."""
    raw = _as_bytes(word, misread)
    out, at = [], 0
    for m in _UTF8.finditer(raw):
        try:
            c = m[0].encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        if "\x80" <= c < "\xa0" and misread != "latin-1":
            continue
        out += [word[at : m.start()], c]
        at = m.end()
    return "".join([*out, word[at:]]) if out else None


def _undo_single(word: str, misread: str, written: str) -> str | None:
    """The word with each character of ``misread`` read as ``written``; null if any has no byte or nothing changes."""
    raw = _as_bytes(word, misread)
    if "\x00" in raw:
        return None
    new = raw.translate(_FROM_BYTES[written])
    return new if new != word else None


_MISREAD_SIGN = re.compile("[ÂÃÅÐÎÏ├┬╨√‚вЂГΓ]")


def undo(text: str) -> str:
    """Complete UTF-8 sequences that were read in another encoding, given back, so that marks and old letters can be seen."""
    for _ in range(2):
        if not _MISREAD_SIGN.search(text):
            break
        for e in ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251", "cp1250"):
            new = _undo_utf8(text, e)
            if new is not None:
                text = new
                break
        else:
            break
    return text


_BARE = re.compile("A(?=[\xa0-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ])")
_BARE_A = re.compile("a(?=€)")


def _undo_bare(word: str, lead: str) -> str | None:
    """UTF-8 read as Windows-1252 whose leading letters lost their accents afterwards."""
    full = _BARE_A.sub("â", _BARE.sub(lead, word))
    if full == word:
        return None
    new = _undo_utf8(full, "cp1252")
    return None if new is None or lead in new and lead not in word else new


def steps(word: str) -> dict[str, tuple[str, float]]:
    """Readings one step away, from the name of the step to (reading, cost in bits)."""
    out: dict[str, tuple[str, float]] = {}
    seen = {word}
    for e in MISREAD_AS:
        new = _undo_utf8(word, e)
        if new is not None and new not in seen:
            seen.add(new)
            out[f"{e}>utf-8"] = (new, STEP_BITS)
    for lead in "ÃÂ":
        new = _undo_bare(word, lead)
        if new is not None and new not in seen:
            seen.add(new)
            out[f"bare-{lead}>utf-8"] = (new, 2 * STEP_BITS)
    if word.endswith("Ã") and len(word) < 4:  # an a with grave accent whose no-break space became a space
        out["space>utf-8"] = (word[:-1] + "à", 2 * STEP_BITS)
    if any("\x80" <= c < "\xa0" for c in word):
        new = "".join(_FROM_BYTES["cp1252"].get(ord(c), c) if "\x80" <= c < "\xa0" else c for c in word)
        if new not in seen:
            seen.add(new)
            out["latin-1>cp1252"] = (new, STEP_BITS)
    for e in MISREAD_AS:
        for w in WRITTEN_IN:
            if e != w and not (e in ("latin-1", "iso8859-2") and w == "cp1250"):
                new = _undo_single(word, e, w)
                if new is not None and new not in seen:
                    seen.add(new)
                    out[f"{e}>{w}"] = (new, 1.5 * STEP_BITS)
    return out


def plausible(text: str) -> bool:
    """No control characters, no box drawing, no private or unassigned code points: what a reading may hold."""
    return not any("\x80" <= c < "\xa0" or "─" <= c <= "▟" or "" <= c <= "" for c in text)


def readings(word: str) -> dict[str, tuple[str, float]]:
    """All readings of a word by chains of up to DEEPEST steps of which the first ones undo UTF-8; cheapest chain of each."""
    best: dict[str, tuple[str, float]] = {}
    front = [("", word, 0.0)]
    for _ in range(DEEPEST):
        later = []
        for chain, text, cost in front:
            for name, (new, bits) in steps(text).items():
                total = cost + bits
                if new != word and (new not in best or best[new][1] > total):
                    best[new] = (f"{chain}|{name}".lstrip("|"), total)
                    if name.endswith(">utf-8"):
                        later.append((best[new][0], new, total))
        front = later
    return best


def pieces(word: str) -> list[str]:
    """A run without blanks in pieces that make it up: whole up to WINDOW characters, else cut after signs and, if need be, beside ASCII letters.

    Bytes of one character are never parted, as all of them are read as characters beyond ASCII: a stretch of
    those stays whole at any length.
    """
    if len(word) <= WINDOW:
        return [word]
    out: list[str] = []
    for p in _PIECE.findall(word):
        if len(p) <= WINDOW:
            out.append(p)
            continue
        cur = ""
        for q in _ALTERNATE.findall(p):
            if cur and len(cur) + len(q) > WINDOW:
                out.append(cur)
                cur = ""
            cur += q
        out.append(cur)
    return out


def fragments(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, word before, word, word after) of each word with characters beyond ASCII; neighbours may be empty. Long runs come in pieces."""
    for m in _WORD.finditer(text):
        a, b = m.span()
        left = _BEFORE.search(text, max(0, a - 40), a)
        right = _AFTER.match(text, b, min(len(text), b + 40))
        x, y = left[1] if left else "", right[1] if right else ""
        if b - a <= WINDOW:
            yield a, b, x, m[0], y
            continue
        at = a
        for p in pieces(m[0]):
            end = at + len(p)
            if not p.isascii():
                yield at, end, x if at == a else "", p, y if end == b else ""
            at = end


def _shape(s: str) -> str:
    return _DIGITS.sub("0", s)


def _phrase(before: str, word: str, after: str) -> str:
    return f" {before} {word} {after} "


# ---- the dictionaries -------------------------------------------------------------------------


def count_fragments(texts: DataFrame) -> DataFrame:
    """(lang, before, word, after, n) over all rows of ``texts`` (lang, text), digits as 0."""

    def run(batches):
        for b in batches:
            n: Counter = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text and not text.isascii():
                    n.update((lang, _shape(x), _shape(w[k : k + WINDOW]), _shape(y)) for _, _, x, w, y in fragments(text) for k in range(0, len(w), WINDOW))
            keys = list(n)
            yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.string()) for i in range(4)], pa.array([n[k] for k in keys], pa.int64())], names=["lang", "before", "word", "after", "n"])

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, before string, word string, after string, n bigint")
    return counted.groupBy("lang", "before", "word", "after").agg(F.sum("n").alias("n"))


def frequent_fragments(texts: DataFrame, per_language: int = FRAGMENTS_PER_LANGUAGE) -> tuple[list[tuple[str, str, str, str, int]], Counter]:
    """(fragments, words): of each label the words' most frequent surroundings, CONTEXTS a word, and how often each word stands in all.

    Both lists are bounded: ``per_language`` fragments of each of the labels in LABELS, and WORDS words. Ranks within a
    word come first, so that frequent words with many surroundings don't crowd out the rare ones.
    """
    counted = materialise(count_fragments(texts), "fragments")
    own = Window.partitionBy("lang", "word").orderBy(F.col("n").desc(), "before", "after")
    best = counted.withColumn("_r", F.row_number().over(own)).where(F.col("_r") <= CONTEXTS)
    totals = counted.groupBy("word").agg(F.sum("n").alias("total")).where(F.col("total") > 1)
    words = totals.orderBy(F.col("total").desc(), "word").limit(WORDS)
    order = Window.partitionBy("lang").orderBy("_r", F.col("n").desc(), "word", "before", "after")
    top = best.join(totals, "word").withColumn("_o", F.row_number().over(order)).where(F.col("_o") <= per_language)
    got = top.orderBy("lang", "_o").select("lang", "before", "word", "after", "n").collect()
    return [tuple(r) for r in got], Counter({r["word"]: r["total"] for r in words.collect()})


def clean_words(words: Counter) -> tuple[Counter, dict[str, str]]:
    """The words without those that are misreadings of other ones, and the misreadings with what they stand for.

    A complete UTF-8 sequence is hardly ever written by intent, so a word that is one is dropped if
    its reading is plausible. For the other chains the more frequent of two words is the true one.
    """
    bad: dict[str, str] = {}
    for w, n in words.items():
        if LOST in w:
            bad[w] = w
            continue
        for new, (chain, _) in readings(w).items():
            m = words.get(new, 0)
            if chain.endswith(">utf-8") and "bare" not in chain and "space" not in chain:
                if plausible(new) and (m > 0 or not plausible(w) or not new.isascii()):
                    bad[w] = new
                    break
            elif m > 2 * n and plausible(new):
                bad[w] = new
                break
    return Counter({w: n for w, n in words.items() if w not in bad}), bad


def build_dictionaries(rows: list[tuple[str, str, str, str, int]], words: Counter | None = None) -> dict[str, bytes]:
    """Per language the text of its dictionary: clean fragments in the order given, the first of them last, where references are shortest."""
    if words is None:
        words = Counter()
        for _, _, w, _, n in rows:
            words[w] += n
    clean, _ = clean_words(words)
    out: dict[str, bytes] = {}
    for lang in dict.fromkeys(r[0] for r in rows):
        parts, size = [], 0
        for _, x, w, y, _ in (r for r in rows if r[0] == lang and r[2] in clean):
            x, y = (v if v.isascii() or v in clean else "" for v in (x, y))
            p = _phrase(x, w, y).encode("utf-8", "surrogatepass")
            if size + len(p) > DICTIONARY_BYTES:
                break
            parts.append(p)
            size += len(p)
        if parts:
            out[lang] = b"".join(reversed(parts))
    return out


# How labels name the languages that have a dictionary of their own.
LABELS = {"en": ("en", "eng", "english"), "fr": ("fr", "fre", "fra", "french"), "de": ("de", "ger", "deu", "german"), "es": ("es", "spa", "spanish"), "it": ("it", "ita", "italian")}


def language_column(label: F.Column) -> F.Column:
    """The language a label names, by code with or without region or by English name; ``other`` if none."""
    base = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    out = F.lit("other")
    for code, names in LABELS.items():
        out = F.when(base.isin(*names), code).otherwise(out)
    return F.coalesce(out, F.lit("other"))


# ---- choosing -----------------------------------------------------------------------------------


class Repairer:
    """Chooses readings with the dictionaries; remembers the fragments and words it has seen, digits as 0."""

    def __init__(self, dictionaries: dict[str, bytes], cache: int = 200_000):
        self.coders = []
        for raw in dictionaries.values():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=18, search_log=SEARCH_LOG, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        if not self.coders:
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
        held = Counter(w for raw in dictionaries.values() for w in raw.decode("utf-8", "replace").split(" ") if w and not w.isascii())
        self.known = set(held)
        self.signs = Counter(c for w in held for c in w if c > "\x7f")
        self.fill: dict[str, set[str]] = {}
        for w in self.known:
            core = w.strip(OUTER)
            self.fill.setdefault(_NOT_ASCII.sub(LOST, core), set()).add(core)
        self.cache: dict[tuple[str, str, str], tuple[str, str]] = {}
        self.words: dict[str, list[tuple[str, float, str]]] = {}
        self.limit = cache

    def bits(self, text: str) -> float:
        """The description length of a text in the language that codes it best; characters no text should hold cost extra."""
        raw = text.encode("utf-8", "surrogatepass")
        return 8.0 * min([len(c.compress(raw)) for c in self.coders]) + ODD_BITS * sum(not plausible(c) for c in text if c > "\x7f")

    def options(self, word: str) -> list[tuple[str, float, str]]:
        """(reading, cost, chain) of a word in digit-free form, those that pass the exact check, cheapest first."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) > self.limit:
                self.words.clear()
            found = readings(word)
            if LOST in word:
                for new in self._filled(word):
                    found[new] = ("lost", 2 * STEP_BITS)
            got = sorted((new, cost, chain) for new, (chain, cost) in found.items() if self.admissible(word, new, chain))
            got.sort(key=lambda v: v[1])
            if len(word) <= 2 * WINDOW:  # longer ones are hardly met again
                self.words[word] = got
        return got

    def choose(self, before: str, word: str, after: str, free: frozenset[str] = frozenset()) -> tuple[str, str]:
        """(chain, reading) of a fragment in digit-free form: the empty chain if the word stays. Chains in ``free`` cost nothing."""
        options = self.options(word)
        if not options:
            return "", word
        key = (before, word, after, free)
        got = self.cache.get(key)
        if got is None:
            if len(self.cache) > self.limit:
                self.cache.clear()
            best = (self.bits(_phrase(before, word, after)), "", word)
            strange = word not in self.known and not _LOOKALIKE.search(word)
            for new, cost, chain in options:
                total = self.bits(_phrase(before, new, after)) + (0.0 if chain in free else cost) - KNOWN_BITS * (strange and new in self.known)
                if total < best[0] or (total == best[0] and chain in free and not best[1]):
                    best = (total, chain, new)
            got = best[1], best[2]
            if len(word) <= 2 * WINDOW:
                self.cache[key] = got
        return got

    def _filled(self, word: str) -> list[str]:
        """Known words that fit a word with lost characters, if just one does."""
        core = word.strip(OUTER)
        found = self.fill.get(_NOT_ASCII.sub(LOST, core), set())
        return [word.replace(core, next(iter(found)))] if len(found) == 1 else []

    def admissible(self, word: str, new: str, chain: str) -> bool:
        """The exact check beside the choice by length.

        A whole UTF-8 sequence is proof enough. Readings by single-byte encodings and the like must lead
        from a word the corpus doesn't know to one it knows, or at least from rare signs to common ones.
        """
        if not plausible(new) and plausible(word):
            return False
        if chain == "lost" or chain == "latin-1>cp1252" or (chain.endswith(">utf-8") and "bare" not in chain and "space" not in chain):
            return True
        if word in self.known or not plausible(new):
            return False
        if new in self.known or new.isascii():
            return new in self.known
        fresh = [self.signs[c] for c in set(new) - set(word) if c > "\x7f"]
        stale = [self.signs[c] for c in set(word) - set(new) if c > "\x7f"]
        return bool(fresh) and min(fresh) > 20 * (1 + max(stale, default=0))

    def repair(self, text: str | None) -> tuple[str | None, list[str], int]:
        """(restored text, chains used, characters that cannot be restored)."""
        if not text or text.isascii():
            return text, [], 0
        found = list(fragments(text))
        picked = [self.choose(_shape(x), _shape(w), _shape(y)) for _, _, x, w, y in found]
        used = frozenset(c for c, _ in picked if c)
        if used and len(picked) > 1:  # a chain that the text has already paid for is free for its other words
            picked = [p if p[0] else self.choose(_shape(f[2]), _shape(f[3]), _shape(f[4]), used) for p, f in zip(picked, found, strict=True)]
        out, at = [], 0
        for (a, b, _, w, _), (chain, new) in zip(found, picked, strict=True):
            if chain:
                out += [text[at:a], _digits_back(w, new)]
                at = b
        new = "".join([*out, text[at:]]) if out else text
        lost = new.count(LOST) + sum("\x80" <= c < "\xa0" and c != "\x85" for c in new)
        return new, sorted({c for c, _ in picked if c}), lost


def _digits_back(word: str, shaped: str) -> str:
    """A digit-free reading with the word's own numbers, which no chain touches."""
    numbers = iter(_DIGITS.findall(word))
    return re.sub("0", lambda m: next(numbers, m[0]), shaped)


def repair_column(df: DataFrame, keep: list[str], text: str, dictionaries: dict[str, bytes]) -> DataFrame:
    """(keep..., restored string, chains array<string>, lost int, damaged boolean) for each row.

    ``restored`` is the text as it was, wherever a shorter reading was found; ``lost`` counts the
    characters left that no reading explains (replacement characters, stray controls); a row is
    ``damaged`` if any character was restored or lost. Null gives null, and no damage; empty and plain
    ASCII texts are as they were; a text of any length is read whole. Row by row, without shuffle.
    """
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    shipped = df.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        r = Repairer(shipped.value)
        for b in batches:
            done = [r.repair(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(keep))], pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.list_(pa.string())), pa.array([d[2] for d in done], pa.int32()), pa.array([bool(d[1] or d[2]) for d in done])],
                names=[*keep, "restored", "chains", "lost", "damaged"],
            )

    out = df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{schema}, restored string, chains array<string>, lost int, damaged boolean")
    return out


def learn(texts: DataFrame) -> dict[str, bytes]:
    """Dictionaries from all rows of ``texts`` (lang, text); their size is bounded by DICTIONARY_BYTES a language."""
    return build_dictionaries(*frequent_fragments(texts))
