"""Tables of keys that outgrow what a task may hold.

A task holds the most frequent keys and a filter of fixed size over all others. What passes the filter is noted while
a text is read, answered by join, and the text read again, until it asks nothing that hasn't been answered. So each
text is read with the whole table, whatever part of it the tasks hold.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6  # hexadecimal, of a place in the filter: 2 MB; a fuller filter costs rows in the join, no results
PLACES = 3  # of a key


def filter_of(keys: DataFrame) -> bytes:
    """The filter over the column ``key``. What comes to the driver is a number of rows that the filter's size bounds."""
    at = F.explode(F.array(*[F.conv(F.substring(F.md5("key"), 1 + DIGITS * i, DIGITS), 16, 10).cast("bigint") for i in range(PLACES)]))
    got = keys.select(at.alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toArrow()
    bits = np.zeros(16**DIGITS // 64, "<i8")
    bits[got.column("slot").to_numpy()] = got.column("bits").to_numpy()
    return bits.tobytes()


class Asker:
    """The answers known for the text at hand; notes the keys that have none yet."""

    def __init__(self, bits: bytes, limit: int = 300_000):
        self.bits, self.limit = bits, limit
        self.held: dict[str, bool] = {}
        self.answers: dict[str, tuple | None] = {}
        self.asked: set[str] = set()

    def begin(self, answers: dict[str, tuple | None]) -> None:
        """A new text, with the answers to what it is known to ask; None for a key that isn't in the table."""
        self.answers, self.asked = answers, set()

    def may_hold(self, key: str) -> bool:
        """False only for keys that aren't in the table."""
        got = self.held.get(key)
        if got is None:
            if len(self.held) > self.limit:
                self.held.clear()
            h = md5(key.encode()).hexdigest()
            at = [int(h[DIGITS * i : DIGITS * (i + 1)], 16) for i in range(PLACES)]
            got = self.held[key] = all(self.bits[p >> 3] >> (p & 7) & 1 for p in at)
        return got

    def get(self, key: str) -> tuple | None:
        if not self.may_hold(key):
            return None
        if key not in self.answers:
            self.asked.add(key)
        return self.answers.get(key)


class Layered:
    """A set: what a task holds, and the keys of one kind in the rest of the table."""

    def __init__(self, held: frozenset[str], kind: str, rest: Asker):
        self.held, self.kind, self.rest = held, kind, rest

    def __contains__(self, x: str) -> bool:
        return x in self.held or self.rest.get(self.kind + x) is not None


class Possible(Layered):
    """The same for a set that only says where looking further may be worth it: the filter's answer is enough."""

    def __contains__(self, x: str) -> bool:
        return x in self.held or self.rest.may_hold(self.kind + x)
