"""Byte-level BPE over whole columns, with vectorised pre-tokenisation.

The pre-tokeniser is the usual one for byte-level vocabularies (contractions, an optional space
before a run of letters, digits or other signs, and white space that leaves its last character to
the word after it). It is run without regular expressions: all texts of a batch become one array
of code points, a table gives each its class, and a small automaton reads the classes. Each class
is a function from states to states; such functions compose associatively, so the batch is cut
into blocks, the blocks' functions are composed side by side, scanned, and applied, all as array
operations. The slices between boundaries go through a cache of merged pieces.
"""

from __future__ import annotations

import base64
import functools
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k"
CACHE_PIECES = 400_000  # pieces kept by a worker; when full the cache starts anew

# classes of characters as the automaton reads them
LETTER, DIGIT, OTHER, WHITE, LAST_SPACE, LAST_WHITE, CUT_ONE, CUT_TWO, END = range(9)
# states: nothing yet, in a run of letters / digits / others / white space, after a space that the
# next run takes, one or two letters of a contraction still to come, a contraction ended
S_START, S_L, S_N, S_O, S_W, S_SPACE, S_ONE, S_TWO, S_DONE = range(9)


def vocabulary_path(name: str = VOCABULARY, path: str | None = None) -> str:
    """The file of ranks: ``path``, else the environment's PAPYR_TOKENIZERS folder, else the installed package of vocabularies."""
    if path:
        return path
    folder = os.environ.get("PAPYR_TOKENIZERS")
    if folder:
        return os.path.join(folder, f"{name}.tiktoken")
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of each code point: letter, digit, white space or other."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(m[0][0]), ord(m[0][-1])
            table[a : b + 1] = kind
    return table


@functools.lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and whether a token begins before a character of that class in that state."""
    step = np.zeros((9, 9), np.uint8)
    begins = np.ones((9, 9), bool)
    run = {LETTER: S_L, DIGIT: S_N, OTHER: S_O}
    for kind, state in run.items():
        step[kind, :] = state
        begins[kind, [state, S_SPACE]] = False
    step[LETTER, S_TWO], step[LETTER, S_ONE] = S_ONE, S_DONE
    begins[LETTER, [S_ONE, S_TWO]] = False
    step[WHITE, :], step[LAST_WHITE, :], step[LAST_SPACE, :] = S_W, S_W, S_SPACE
    begins[WHITE, S_W] = False
    for kind, state in ((CUT_ONE, S_ONE), (CUT_TWO, S_TWO)):
        step[kind, :] = state
        step[kind, [S_O, S_SPACE]] = S_O  # inside a run of signs an apostrophe opens nothing
        begins[kind, [S_O, S_SPACE]] = False
    step[END, :] = S_START
    begins[END, :] = True
    return step, begins


def classify(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The automaton's classes of code points; ``ends`` are the places of the separators between texts."""
    kinds = class_table()[points]
    kinds[ends] = END
    n = len(kinds)
    following = np.empty(n, np.uint8)
    following[:-1], following[-1:] = kinds[1:], END
    last = (kinds == WHITE) & (following != WHITE) & (following != END)
    marks = np.flatnonzero((points == 39) & (kinds == OTHER))
    if len(marks):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        a, b = padded[marks + 1], padded[marks + 2]
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)
        two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))
        kinds[marks[one]] = CUT_ONE
        kinds[marks[two]] = CUT_TWO
    kinds[last & (points == 32)] = LAST_SPACE
    kinds[last & (points != 32)] = LAST_WHITE
    return kinds


def boundaries(kinds: np.ndarray, block: int = 256) -> np.ndarray:
    """The places where tokens begin, by an associative scan of the classes' transition functions."""
    step, begins = automaton()
    n = len(kinds)
    if not n:
        return np.zeros(0, np.int64)
    rows = -(-n // block)
    padded = np.full(rows * block, END, np.uint8)
    padded[:n] = kinds
    grid = np.ascontiguousarray(padded.reshape(rows, block).T)  # grid[j] is the j-th class of every block
    whole = np.tile(np.arange(9, dtype=np.uint8), (rows, 1))  # each block's composed function
    for j in range(block):
        whole = step[grid[j][:, None], whole]
    # prefix of the compositions over blocks, doubling the reach each time
    prefix, reach = whole.copy(), 1
    while reach < rows:
        later = prefix.copy()
        later[reach:] = np.take_along_axis(prefix[reach:], prefix[:-reach].astype(np.intp), axis=1)
        prefix, reach = later, reach * 2
    state = np.empty(rows, np.uint8)
    state[0] = S_START
    state[1:] = prefix[:-1, S_START]
    out = np.empty((block, rows), bool)
    for j in range(block):
        out[j] = begins[grid[j], state]
        state = step[grid[j], state]
    return np.flatnonzero(out.T.reshape(-1)[:n])


def merge(piece: bytes, table: dict[bytes, int]) -> tuple[int, ...]:
    """Merge neighbours of lowest rank first, the leftmost on ties. A heap over a linked list: n log n for long pieces."""
    if piece in table:
        return (table[piece],)
    n = len(piece)
    part: list[bytes] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := table.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if not part[i] or j >= n or len(part[i]) + len(part[j]) != size:
            continue
        part[i] += part[j]
        part[j] = b""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := table.get(both := part[i] + part[k])) is not None:
                heapq.heappush(heap, (r, i, len(both)))
        if (h := before[i]) >= 0 and (r := table.get(both := part[h] + part[i])) is not None:
            heapq.heappush(heap, (r, h, len(both)))
    return tuple(table[p] for p in part if p)


class Encoder:
    """Encodes lists of texts; keeps its cache of pieces between batches."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        self.table, self.limit = ranks(path), cache_pieces
        self.cache: dict[str, tuple[int, ...]] = {}

    def pieces(self, texts: list[str]) -> Iterator[list[str]]:
        """The slices of each text."""
        for text, starts in zip(texts, self.starts(texts), strict=True):
            cuts = starts.tolist()
            yield [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=bool(cuts))]

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(sizes + 1) - 1
        cuts = boundaries(classify(points, ends))
        first = ends - sizes
        lo, hi = np.searchsorted(cuts, first), np.searchsorted(cuts, ends)
        return [cuts[a:b] - f for a, b, f in zip(lo.tolist(), hi.tolist(), first.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        out, cache, table = [], self.cache, self.table
        for pieces in self.pieces(texts):
            if len(cache) > self.limit:
                cache.clear()
            try:
                out.append(list(chain.from_iterable([cache[p] for p in pieces])))
            except KeyError:
                for p in set(pieces):
                    if p not in cache:
                        cache[p] = merge(p.encode("utf-8", "surrogatepass"), table)
                out.append(list(chain.from_iterable([cache[p] for p in pieces])))
        return out

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.encode(texts)]

    def offsets(self, texts: list[str]) -> list[list[int]]:
        """For each text the character at which each id's first byte lies."""
        out, back = [], {v: k for k, v in self.table.items()}
        for text, ids in zip(texts, self.encode(texts), strict=True):
            sizes = np.fromiter((len(back[i]) for i in ids), np.int64, len(ids))
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            at = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character of each byte
            out.append(at[np.cumsum(sizes) - sizes].tolist() if len(ids) else [])
        return out

    def decode(self, ids: list[int]) -> str:
        back = self._back
        return b"".join([back[i] for i in ids]).decode("utf-8", "replace")

    @functools.cached_property
    def _back(self) -> dict[int, bytes]:
        return {v: k for k, v in self.table.items()}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


CHUNK_CHARS = 2_000_000  # characters handled at once, which bounds a worker's memory whatever a batch holds


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of some two million characters; a longer text is a chunk of its own."""
    part: list[str] = []
    size = 0
    for t in texts:
        if part and size + len(t) > CHUNK_CHARS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _columns(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def encode_column(df: DataFrame, key: str, text: str, path: str | None = None, offsets: bool = False) -> DataFrame:
    """(key, ids array<int>[, offsets array<int>]) for each row: ids of the whole text without special tokens.

    Null and empty texts have empty lists; blank texts are encoded as they stand; strings that look
    like special tokens are plain text. One row in, one row out, whatever repeats; no shuffle. A text
    of any length is encoded whole (memory grows with the longest text only).
    """
    where = vocabulary_path(path=path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where)
        for b in batches:
            keys, done = b.column(0), 0
            for part in chunks(_columns(b, "_text")):
                ids = e.encode(part)
                cols = [keys.slice(done, len(part)), _lists(ids)]
                if offsets:
                    cols.append(_lists(e.offsets(part)))
                done += len(part)
                yield pa.RecordBatch.from_arrays(cols, names=["_key", "ids", "offsets"][: len(cols)])

    kind = df.schema[key].dataType.simpleString()
    schema = f"_key {kind}, ids array<int>" + ", offsets array<int>" * offsets
    return df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema).withColumnRenamed("_key", key)


def _lists(rows: list[list[int]]) -> pa.ListArray:
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def count_column(df: DataFrame, text: str, keep: list[str], path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """The columns ``keep`` and the number of tokens of ``text`` (0 for null), as bigint ``name``. The text itself is not carried on."""
    where = vocabulary_path(path=path)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where)
        for b in batches:
            sizes = list(chain.from_iterable(e.count(part) for part in chunks(_columns(b, "_text"))))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(sizes, pa.int64())], names=[*keep, name])

    return df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{schema}, `{name}` bigint")


def decode_column(df: DataFrame, key: str, ids: str = "ids", path: str | None = None) -> DataFrame:
    """(key, text): the texts that lists of ids stand for; null lists give null."""
    where = vocabulary_path(path=path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where)
        for b in batches:
            texts = [None if x is None else e.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["_key", "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("_key"), F.col(ids).alias("_ids")).mapInArrow(run, f"_key {kind}, text string").withColumnRenamed("_key", key)
