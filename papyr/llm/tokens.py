"""Names of words in counts: a word of any length counts, and none takes more room than a digest."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import md5

LONG = 40  # characters from which a word goes by its digest


def name(word: str) -> str:
    """The word itself, or for a very long one a digest of all of it, which is as good as the word for counting and looking up."""
    return word if len(word) <= LONG else "\x00" + md5(word.encode("utf-8", "surrogatepass")).hexdigest()


def names(words: Iterable[str]) -> list[str]:
    return [w if len(w) <= LONG else name(w) for w in words]
