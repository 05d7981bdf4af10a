"""Running headers and page numbers in text from scanned pages.

What a header looks like is learned from the corpus: a line is evidence if it breaks into a sentence, that is, the line
before hasn't ended, the line after goes on in lower case, and the line itself is short of the page's width or
stands apart. Such lines are counted over all texts by their form (classes of words, figures as one class, signs
as they stand) and by their wording; a form that mostly stands where it breaks into sentences is furniture wherever
it stands alone. A line that comes back at page distances within one text is furniture by itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyr.llm.rest import Asker, Layered, Possible
from papyr.session import materialise

FORMS = 20_000  # most frequent forms and wordings that every task holds; the others are asked for (see papyr.llm.rest)
LEAST = 3  # lines that must break into sentences for a form to be known
SHARE = 0.25  # of a form's lines that must do so
RUNNING = 0.6  # the same for a form with a run of words in lower case, as sentences have
WIDTH = 0.85  # of the longest line, below which a line is short
RETURNS = 3  # times a line must come back in one text
PAGE = 4  # lines between two of its places

_CORE = re.compile(r"^([^\w]*)(.*?)([^\w]*)$", re.S)
_ROMAN = re.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_DASH = re.compile("[—–‒―-]")
_ENDS = (".", "!", "?", "”", '"', ":", "’", "»", ";")
_FIGURES = re.compile(r"\d+")


@lru_cache(100_000)
def token_class(token: str) -> str:
    """Figures ``0``, Roman numerals ``R``, capitals ``A``, capitalised ``T``, lower case ``w``, mixed ``x``; outer signs stay, dashes alike."""
    lead, core, tail = _CORE.match(token).groups()  # type: ignore[union-attr]
    if not core:
        return _DASH.sub("-", token)
    low = core.lower()
    if core.isdigit():
        kind = "0"
    elif len(core) > 1 and (core == low or core.isupper()) and _ROMAN.fullmatch(low):
        kind = "R"
    elif core.isupper() and sum(map(str.isalpha, core)) * 2 > len(core):
        kind = "A"
    elif core[0].isupper():
        kind = "T"
    else:
        kind = "w" if core.isalpha() or not any(map(str.isdigit, core)) else "x"
    return _DASH.sub("-", lead) + kind + _DASH.sub("-", tail)


def form(tokens: list[str]) -> str:
    """The classes of a line's words, runs of one class as one."""
    out: list[str] = []
    for t in tokens:
        c = token_class(t)
        if out and c[0] == out[-1][0] and c[0] in "ATw" and len(out[-1].rstrip("+")) == 1:
            out[-1] = c[0] + "+" + c[1:]
        else:
            out.append(c)
    return " ".join(out)


def _wording(line: str) -> str:
    return "=" + _FIGURES.sub("0", " ".join(line.split()))


# a line of at most two words in lower case among others: what a form without running text can look like
_UPPER, _LOWER = (rf"{c}\S*+(?:[^\S\n]++|(?=\n)|\Z)" for c in (r"[^a-zß-ÿ\s]", "[a-zß-ÿ]"))
_LINE = re.compile(rf"^[^\S\n]*+(?:{_UPPER})*+(?:{_LOWER}(?:{_UPPER})*+){{0,2}}+(?=\n|\Z)", re.M)


def breaks_in(before: str, line: str, after: str) -> bool:
    """Whether a line stands inside of a sentence that goes on after it."""
    return after[:1].islower() and not before.endswith(_ENDS) and not (line[:1].islower() and line[-1:].isalpha() and line.count(" "))


def candidates(text: str) -> Iterable[tuple[str, str, bool]]:
    """(form, wording, evidence) of each inner line that could be furniture, in texts of running lines."""
    if "\n" not in text or not any(m[0].strip() for m in _LINE.finditer(text)):
        return
    lines = [x.strip() for x in text.split("\n")]
    full = [i for i, x in enumerate(lines) if x]
    if sum(lines[i].count(" ") + 1 for i in full) < 4 * len(full):
        return
    width = max((len(lines[i]) for i in full), default=0)
    for k in range(1, len(full) - 1):
        x = lines[full[k]]
        if _LINE.match(x):
            before, after = lines[full[k - 1]], lines[full[k + 1]]
            apart = full[k - 1] < full[k] - 1 or full[k + 1] > full[k] + 1
            yield form(x.split()), _wording(x), (apart or len(x) < WIDTH * width) and breaks_in(before, x, after)


@dataclass(frozen=True)
class Forms:
    """Forms and wordings that are furniture, and the words in capitals that stand in such lines: bounded tables, and what they leave out."""

    known: Container[str] = frozenset()
    words: Container[str] = frozenset()
    starts: Container[str] = frozenset()  # beginnings of the forms
    rest: DataFrame | None = field(default=None, compare=False)  # (key): forms after ``f``, words after ``c``, beginnings after ``s``

    def asking(self, rest: Asker) -> Forms:
        return Forms(Layered(self.known, "f", rest), Layered(self.words, "c", rest), Possible(self.starts, "s", rest))


def count_forms(texts: DataFrame) -> DataFrame:
    """(form, n, inside): how often a form or wording stands as a line of its own, and how often it breaks into a sentence; over all texts.

    Words in capitals of lines that break in are counted as ``#`` and the word.
    """

    def run(batches):
        for b in batches:
            n: Counter = Counter()
            inside: Counter = Counter()
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                for f, w, hit in candidates(t):
                    n[f] += 1
                    if hit:
                        inside[f] += 1
                        n[w] += 1
                        inside[w] += 1
                        for x in w[1:].split():
                            x = x.strip(".,;:[]()")
                            if len(x) > 1 and x.isupper():
                                n["#" + x] += 1
                                inside["#" + x] += 1
            keys = list(n)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([n[k] for k in keys], pa.int64()), pa.array([inside[k] for k in keys], pa.int64())], names=["form", "n", "inside"])

    return texts.select("text").mapInArrow(run, "form string, n bigint, inside bigint").groupBy("form").agg(F.sum("n").alias("n"), F.sum("inside").alias("inside"))


def choose(rows: Iterable[tuple[str, int, int]]) -> Forms:
    known, words = set(), set()
    for f, n, inside in rows:
        if inside < LEAST or inside < (RUNNING if "w+" in f and f[0] != "=" else SHARE) * n:
            continue
        if f[0] == "#":
            words.add(f[1:])
        elif not f.endswith(("w-", "w+-")):  # a line that ends in half a word
            known.add(f)
    starts = set()
    for parts in (k.split(" ") for k in known if k[0] != "="):
        for i, last in enumerate(parts, 1):
            starts.add(" ".join(parts[:i]))
            if last[1:2] == "+":  # a run as it grows
                starts |= {" ".join([*parts[: i - 1], x]) for x in (last[0], last[0] + "+")}
    return Forms(frozenset(known), frozenset(words), frozenset(starts))


def learn(texts: DataFrame) -> Forms:
    """The furniture of a corpus. What comes to the driver is FORMS rows at most; the others stay a table."""
    counted = materialise(count_forms(texts).where((F.col("inside") >= LEAST) & (F.col("inside") >= SHARE * F.col("n"))), "forms")
    got = counted.orderBy(F.col("inside").desc(), "form").limit(FORMS + 1).collect()
    forms = choose(tuple(r) for r in got[:FORMS])
    if len(got) <= FORMS:
        return forms
    first = got[FORMS]

    def run(batches):
        for b in batches:
            more = choose(zip(*[c.to_pylist() for c in b.columns], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([kind + x for kind, xs in (("f", more.known), ("c", more.words), ("s", more.starts)) for x in xs], pa.string())], names=["key"])

    left = counted.where((F.col("inside") < first["inside"]) | ((F.col("inside") == first["inside"]) & (F.col("form") >= first["form"])))
    return Forms(forms.known, forms.words, forms.starts, materialise(left.mapInArrow(run, "key string"), "forms-rest"))


# ---- taking it out ----------------------------------------------------------------------------------


def capitals(text: str) -> bool:
    """Whether a text is mostly in capitals, which say nothing there."""
    letters = sum(map(str.isalpha, text))
    return letters > 0 and sum(map(str.isupper, text)) > 0.5 * letters


def _returning(text: str) -> set[str]:
    """Wordings of lines that come back at page distances and break into a sentence at half of their places or more."""
    lines = [" ".join(x.split()) for x in _FIGURES.sub("0", text).split("\n")]
    often = {x for x, n in Counter(lines).items() if n >= RETURNS and x and not x.endswith((",", ";", "-"))}
    if not often:
        return often
    full = [x for x in lines if x]
    places: dict[str, list[int]] = {}
    for i, x in enumerate(full):
        if x in often:
            places.setdefault(x, []).append(i)
    inside = {x: sum(0 < i < len(full) - 1 and breaks_in(full[i - 1], x, full[i + 1]) for i in at) for x, at in places.items()}
    return {"=" + x for x, at in places.items() if 2 * inside[x] >= len(at) and all(b - a >= PAGE for a, b in zip(at, at[1:], strict=False))}


def _numbered(f: str) -> bool:
    return "0" in f or "R" in f


def own_lines(text: str, forms: Forms) -> tuple[str, int]:
    """(text, lines taken out). A first or last line is never furniture; lines of furniture next to one another count as one place."""
    back = _returning(text) if text.count("\n") > RETURNS * PAGE else set()
    if not back and not any(m[0].strip() for m in _LINE.finditer(text)):
        return text, 0
    lines = text.split("\n")
    bare = [x.strip() for x in lines]
    full = [i for i, x in enumerate(bare) if x]
    found: dict[int, str] = {}
    for k in range(1, len(full) - 1):
        x = bare[full[k]]
        if (back and _wording(x) in back) or (_LINE.match(x) and ((f := form(x.split())) in forms.known or _wording(x) in forms.known)):
            found[k] = form(x.split())
    if not found:
        return text, 0
    loud = capitals(text)
    width = max(len(bare[i]) for i in full)
    drop: set[int] = set()
    k = 1
    while k < len(full) - 1:
        if k not in found:
            k += 1
            continue
        end = k
        while end + 1 in found:
            end += 1
        before, after = bare[full[k - 1]], bare[full[end + 1]]
        for j in range(k, end + 1):
            x, f = bare[full[j]], found[j]
            apart = full[j] - 1 > full[j - 1] or full[j + 1] > full[j] + 1 or len(before) + len(x) < width
            inside = breaks_in(before, x, after)
            if f == "0." or (f == "0" and not apart):
                continue  # a figure that ends a sentence, or is part of one, in running lines
            if _numbered(f) or _wording(x) in back:
                ok = True
            elif "A" in f and "w" not in f:
                ok = not loud and not (before.isupper() and after.isupper())
            else:
                ok = inside or not before.endswith(_ENDS)
            if ok:
                drop.add(full[j])
        k = end + 1
    return (_splice(lines, drop), len(drop)) if drop else (text, 0)


def _splice(lines: list[str], drop: set[int]) -> str:
    """The lines without the dropped ones; where those broke into a sentence, the blank lines around them go as well."""
    out: list[str] = []
    i = 0
    while i < len(lines):
        if i in drop:
            while out and not out[-1].strip():
                out.pop()
            while i < len(lines) and (i in drop or not lines[i].strip()):
                i += 1
            goes_on = bool(out) and i < len(lines) and (lines[i].lstrip()[:1].islower() or not out[-1].rstrip().endswith((".", "!", "?", "”", '"', ":")))
            if out and i < len(lines) and not goes_on:
                out.append("")
            continue
        out.append(lines[i])
        i += 1
    return "\n".join(out)


_TOKEN = re.compile(r"\S+")
# where a piece may begin: a capital or figure inside of a sentence, a bracket, dash or word in capitals anywhere
_BEGINS = re.compile(r"(?<=[^\s.!?])\s+(?=[A-ZÀ-Þ\d])|\s+(?=[\[(—–]|-\s|[A-ZÀ-Þ]{2})")
_LEFT_OPEN = ("-", "¬", "=", "‐")
# what every piece shows somewhere: two capitals, or a stop or figure before a word in lower case
_SHOWS = (re.compile(r"[A-ZÀ-Þ]{2}"), re.compile(r"\.\s+[\"“]?[a-zß-ÿ]"), re.compile(r"\d\s+[\"“]?[a-zß-ÿ]"))


def inline(text: str, forms: Forms) -> tuple[str, int]:
    """(text, pieces taken out) of furniture that stands within a line, where the page's lines were run together.

    A piece has a known form and breaks into a sentence. Without figures it must be in capitals of words that stand
    in headers, or close with a stop before a lower-case word.
    """
    if not ("[" in text or "(" in text or any(x in text for x in ("- ", "¬ ", "= ", "‐ ", "— ", "– ")) or any(r.search(text) for r in _SHOWS)):
        return text, 0
    drop: list[tuple[int, int]] = []
    at = 0
    loud = None
    for m in _BEGINS.finditer(text):
        if m.start() < at:
            continue
        end = _longest(text, m.end(), forms)
        if end:
            if loud is None:
                loud = capitals(text)
            if loud:
                return text, 0
            drop.append((m.start(), end))
            at = end
    if not drop:
        return text, 0
    out, at = [], 0
    for a, b in drop:
        out.append(text[at:a] + " ")
        at = b + len(text[b:]) - len(text[b:].lstrip())
    return "".join([*out, text[at:]]), len(drop)


def _token_before(text: str, at: int) -> str:
    while at and text[at - 1].isspace():
        at -= 1
    begin = at
    while begin and not text[begin - 1].isspace():
        begin -= 1
    return text[begin:at]


def _longest(text: str, start: int, forms: Forms) -> int:
    """The end of the longest piece of furniture that begins at ``start``, or 0."""
    best = 0
    out: list[str] = []
    piece: list[str] = []
    before = ""
    end = start
    for m in _TOKEN.finditer(text, start):
        if text.count("\n", end, m.start()) > 1:
            break  # no piece goes over a blank line
        end = m.end()
        c = token_class(m[0])
        if out and c[0] == out[-1][0] and c[0] in "ATw" and len(out[-1].rstrip("+")) == 1:
            out[-1] = c[0] + "+" + c[1:]
        else:
            out.append(c)
        piece.append(m[0])
        f = " ".join(out)
        if f in forms.known:
            before = before or _token_before(text, start)
            nxt = _TOKEN.search(text, m.end())
            if nxt and _fits(f, piece, before, nxt[0], forms):
                best = m.end()
        elif f not in forms.starts:
            break
    return best


def _fits(f: str, piece: list[str], before: str, after: str, forms: Forms) -> bool:
    if f[0] in "[(-" and f[-1] in "])-" and _numbered(f) and "A" not in f:
        return True  # a figure between marks
    if f in ("T. 0", "A. 0"):
        return _wording(" ".join(piece)) in forms.known
    if len(piece) < 2 or f in ("w. 0", "0 ."):
        return False
    if f.startswith("[0] ") and "T" in f:
        return True
    if not (after[:1].islower() or (after[:1] in "“\"" and after[1:2].islower())) and not before.endswith(_LEFT_OPEN):
        return False
    caps = [t.strip(".,;:[]()") for t in piece]
    caps = [t for t in caps if len(t) > 1 and t.isupper() and not _ROMAN.fullmatch(t.lower())]
    if caps:
        return 2 * sum(t in forms.words for t in caps) >= len(caps)
    if before.endswith((".", "!", "?")):
        return False
    # a title: it closes with a stop, or has the page's figure
    return "T" in f and (piece[-1].endswith(".") or _numbered(f)) and "," not in f


def without_furniture(text: str, forms: Forms) -> tuple[str, int]:
    """(text, number of pieces taken out): lines first, then what stands within lines. Null forms take out nothing."""
    n = 0
    if "\n" in text:
        text, n = own_lines(text, forms)
    new, m = inline(text, forms)
    return new, n + m
