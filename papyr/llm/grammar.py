"""A small context-free grammar over words, with a chart parser.

A production is ``name = sequence | sequence``; a sequence holds words, ``<name>`` of another production, ``word*`` for words
that begin so, ``~n`` for up to n words of any kind, and ``?`` after a part that may be absent. Ambiguity is kept: a
chart holds for each name and place all places at which it may end, so no reading is lost and none is tried twice.
Productions may not begin with themselves.
"""

from __future__ import annotations

from collections.abc import Iterable

Item = tuple[str, str, bool]  # kind (word, stem, name, gap), value, may be absent


class Grammar:
    def __init__(self, text: str, start: str, common: Iterable[str] = ()):
        self.rules: dict[str, list[list[Item]]] = {}
        self.start = start
        for line in text.strip().splitlines():
            line = line.strip()
            if line and not line.startswith("#"):
                name, _, body = line.partition(" = ")
                self.rules.setdefault(name.strip(), []).extend([self._item(x) for x in s.split()] for s in body.split(" | "))
        self.common = frozenset(common)
        words, stems = self._need(start)
        self.words, self.stems = frozenset(words), tuple(sorted(stems))
        # of each name, its sequences by the word they begin with, and those that begin with a stem
        self.by_word: dict[str, dict[str, list[list[Item]]]] = {}
        self.by_stem: dict[str, list[tuple[tuple[str, ...], list[Item]]]] = {}
        for name, sequences in self.rules.items():
            own = self.by_word.setdefault(name, {})
            loose = self.by_stem.setdefault(name, [])
            for seq in sequences:
                first = self._first_of(seq)
                stems_of = tuple(w[:-1] for w in first if w.endswith("*"))
                for w in first:
                    if not w.endswith("*"):
                        own.setdefault(w, []).append(seq)
                if stems_of:
                    loose.append((stems_of, seq))
        first = {w for seq in self.rules[start] for w in self._first_of(seq)}
        self.opens, self.open_stems = frozenset(w for w in first if not w.endswith("*")), tuple(w[:-1] for w in first if w.endswith("*"))

    @staticmethod
    def _item(x: str) -> Item:
        absent = x.endswith("?")
        x = x[:-1] if absent else x
        if x[0] == "<":
            return "name", x[1:-1], absent
        if x[0] == "~":
            return "gap", x[1:], True
        return ("stem", x[:-1], absent) if x.endswith("*") else ("word", x, absent)

    def _first_of(self, seq: list[Item]) -> set[str]:
        """Words with which a sequence may begin, stems with a star."""
        out: set[str] = set()
        for kind, value, absent in seq:
            if kind == "gap":
                raise ValueError("a sequence may not begin with a gap")
            if kind == "name":
                out |= {w for s in self.rules[value] for w in self._first_of(s)}
            else:
                out.add(value + "*" * (kind == "stem"))
            if not absent:
                break
        return out

    def _need(self, name: str, within: frozenset[str] = frozenset()) -> tuple[set[str], set[str]]:
        """(words, stems) of which every text of a name holds one, as rare ones as may be: from each sequence the part with the fewest common words.

        A name inside of itself needs nothing of its own: its other parts do.
        """
        words: set[str] = set()
        stems: set[str] = set()
        for seq in self.rules[name]:
            best: tuple[float, set[str], set[str]] | None = None
            for kind, value, absent in seq:
                if absent or (kind == "name" and value in within | {name}):
                    continue
                w, s = self._need(value, within | {name}) if kind == "name" else ({value}, set()) if kind == "word" else (set(), {value})
                cost = len(w) + 100 * len(w & self.common) + 20 * len(s)
                if best is None or cost < best[0]:
                    best = cost, w, s
            if best is None:
                raise ValueError(f"a sequence of {name} may be empty")
            words |= best[1]
            stems |= best[2]
        return words, stems

    def may_hold(self, words: Iterable[str]) -> bool:
        """Whether a text has one of the words that every match needs; false only where there is no match."""
        return not self.words.isdisjoint(words) or (bool(self.stems) and any(w.startswith(self.stems) for w in words))

    def find(self, words: list[str]) -> tuple[int, int] | None:
        """(first, after the last word) of the first place where the start symbol matches, as long as possible; null if none."""
        chart: dict[tuple[str, int], frozenset[int]] = {}
        for i, w in enumerate(words):
            if w in self.opens or w.startswith(self.open_stems):
                ends = self._ends(self.start, i, words, chart)
                if ends:
                    return i, max(ends)
        return None

    def _ends(self, name: str, at: int, words: list[str], chart: dict) -> frozenset[int]:
        got = chart.get((name, at))
        if got is not None:
            return got
        n = len(words)
        out: set[int] = set()
        word = words[at]
        for seq in [*self.by_word[name].get(word, ()), *[q for stems, q in self.by_stem[name] if word.startswith(stems)]]:
            places = {at}
            for kind, value, absent in seq:
                if kind == "gap":
                    places = {q for p in places for q in range(p, min(p + int(value), n) + 1)}
                    continue
                if kind == "word":
                    nxt = {p + 1 for p in places if p < n and words[p] == value}
                elif kind == "stem":
                    nxt = {p + 1 for p in places if p < n and words[p].startswith(value)}
                else:
                    nxt = {q for p in places if p < n for q in self._ends(value, p, words, chart)}
                places = places | nxt if absent else nxt
                if not places:
                    break
            out |= places
        got = chart[name, at] = frozenset(out - {at})
        return got
