"""Subject areas of documents: term weighting, truncated SVD, and cosine similarity to refined seed centroids.

Terms are weighed by their rarity within their own language. The singular vectors come from randomised
subspace iteration: each pass multiplies the whole corpus' matrix with a thin one, and only thin sums
leave the partitions. Every subject has a seed centroid in each language of its examples; the
centroids move towards the documents that lie close to them, over all documents, some rounds long.
A document is about the subject of its closest centroid, and about a second one if that explains a
fair part of what the first leaves over.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyr.llm.defects import guess
from papyr.llm.tokens import names
from papyr.session import materialise

TERMS = 30_000  # most widespread terms that make up the vectors
MIN_DOCUMENTS = 4  # that hold a term, and MIN_SHARE of all
MIN_SHARE = 1e-5
COMMON = 0.7  # nats of rarity below which a term weighs nothing (half of a language's documents hold it)
RANK = 96  # dimensions kept
OVERSAMPLE = 16
PASSES = 3  # of the subspace iteration
ROUNDS = 6  # of the centroids' refinement
SEED_WEIGHT = 3.0  # of the examples against documents when a centroid moves
NEAR = 0.4  # least cosine for a document to be about a subject
SECOND = 0.2  # least part of a second subject
BLOCK = 256  # terms in a block of the sums that are added up in one task

_WORD = re.compile(r"(?<![\d_])[^\W\d_]{3,}(?![\d_])")


def words(text: str | None) -> list[str]:
    return names(_WORD.findall(text.lower())) if text else []


def count_terms(documents: DataFrame) -> DataFrame:
    """(word, lang, n): the documents of a language, by their function words, that hold a word; word '' counts the documents."""

    def run(batches):
        for b in batches:
            n: Counter = Counter()
            for text in b.column(0).to_pylist():
                kinds = set(words(text))
                lang = guess(kinds) or "other"
                n.update((w, lang) for w in kinds)
                n["", lang] += 1
            keys = list(n)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([n[k] for k in keys], pa.int64())], names=["word", "lang", "n"])

    return documents.select("text").mapInArrow(run, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def choose_terms(counts: DataFrame, size: int = TERMS) -> tuple[list[str], np.ndarray]:
    """The vocabulary and its weights: log of one over the share of documents, in the language where the term is most common."""
    totals = {r["lang"]: r["n"] for r in counts.where(F.col("word") == "").collect()}
    every = sum(totals.values())
    of = F.lit(None).cast("double")
    for lang, n in totals.items():
        if lang != "other":
            of = F.when(F.col("lang") == lang, F.lit(float(n + 20))).otherwise(of)
    by_word = counts.where(F.col("word") != "").groupBy("word").agg(F.sum("n").alias("n"), F.max(F.col("n") / of).alias("share"))
    rows = by_word.where((F.col("n") >= max(MIN_DOCUMENTS, MIN_SHARE * every)) & F.col("share").isNotNull()).orderBy(F.col("n").desc(), "word").limit(size).collect()
    kept = [(r["word"], w) for r in rows if (w := -float(np.log(min(r["share"], 1.0))) - COMMON) > 0]
    return [w for w, _ in kept], np.array([x for _, x in kept], np.float32)


def vector(text: str | None, index: dict[str, int], weights: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The terms of a text and their weights, of length one."""
    n = Counter(w for w in words(text) if w in index)
    at = [index[w] for w in n]
    v = (1 + np.log(np.fromiter(n.values(), np.float32, len(n)))) * weights[at] if n else np.zeros(0, np.float32)
    norm = float(np.sqrt((v * v).sum()))
    return at, v / norm if norm > 0 else v


def vectors(documents: DataFrame, terms: list[str], weights: np.ndarray) -> DataFrame:
    """(doc_id, terms array<int>, weights array<float>) of each document."""
    shipped = documents.sparkSession.sparkContext.broadcast(({w: i for i, w in enumerate(terms)}, weights))

    def run(batches):
        index, w = shipped.value
        for b in batches:
            got = [vector(t, index, w) for t in b.column(1).to_pylist()]
            ends = np.zeros(len(got) + 1, np.int32)
            np.cumsum([len(a) for a, _ in got], out=ends[1:])
            flat = np.array([x for a, _ in got for x in a], np.int32)
            vals = np.concatenate([v for _, v in got]).astype(np.float32) if got else np.zeros(0, np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.ListArray.from_arrays(pa.array(ends), pa.array(vals))], names=["doc_id", "terms", "weights"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, terms array<int>, weights array<float>")


def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, terms, weights) of a batch of sparse rows."""
    t, w = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
    ends = np.asarray(t.offsets)
    return ends - ends[0], np.asarray(t.flatten()), np.asarray(w.flatten())


ROWS = 2000  # sparse rows multiplied at once


def multiply(ends: np.ndarray, terms: np.ndarray, weights: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The sparse rows times a dense matrix."""
    n = len(ends) - 1
    out = np.zeros((n, m.shape[1]), np.float32)
    for a in range(0, n, ROWS):
        e = ends[a : a + ROWS + 1]
        full = np.flatnonzero(np.diff(e))
        if len(full):
            part = m[terms[e[0] : e[-1]]] * weights[e[0] : e[-1], None]
            out[a + full] = np.add.reduceat(part, (e[:-1] - e[0])[full], axis=0)
    return out


SUMS_PER_CORE = 2  # tasks a core that make a sum of their own


def _add_up(rows: DataFrame, height: int, width: int, contribute) -> np.ndarray:
    """The sum over all batches of ``contribute(batch, sum so far)`` (height x width), added up in a tree in the cluster.

    Partitions are read one after another by a number of tasks that goes with the cluster's cores, not with the data;
    each gives one sum, in blocks. Blocks are added up in groups of about the root of the number of tasks, and
    the groups' sums by block. What reaches the driver is the sum, of bounded size.
    """
    sc = rows.sparkSession.sparkContext
    n = min(rows.rdd.getNumPartitions(), SUMS_PER_CORE * max(sc.defaultParallelism, 1))
    fan = max(int(n**0.5), 1)

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        group = (context.partitionId() if context else 0) % fan
        total = None
        for b in batches:
            total = contribute(b, total)
        if total is not None:
            for i in range(0, height, BLOCK):
                part = total[i : i + BLOCK]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), pa.array([group], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())], names=["block", "part", "data"])

    def fold(t: pa.Table) -> pa.Table:
        s = None
        for x in t.column("data"):
            v = np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
            s = v if s is None else s + v
        return pa.table({"block": t.column("block")[:1].cast(pa.int32()), "part": t.column("part")[:1].cast(pa.int32()), "data": pa.array([s.astype(np.float32).tobytes()], pa.binary())})

    schema = "block int, part int, data binary"
    sums = rows.coalesce(n).mapInArrow(run, schema)
    if fan > 2:
        sums = sums.groupBy("block", "part").applyInArrow(lambda t: fold(t), schema)
    out = np.zeros((height, width), np.float32)
    for r in sums.groupBy("block").applyInArrow(lambda t: fold(t), schema).collect():
        part = np.frombuffer(r["data"], np.float32).reshape(-1, width)
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(part)] = part
    return out


def singular_vectors(sparse: DataFrame, n_terms: int, rank: int = RANK, passes: int = PASSES, seed: int = 0) -> np.ndarray:
    """The leading right singular vectors (terms x rank) of all rows, by randomised subspace iteration."""
    width = min(rank + OVERSAMPLE, n_terms)
    y = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0].astype(np.float32)
    z = y
    for i in range(passes):
        shipped = sparse.sparkSession.sparkContext.broadcast(y)

        def contribute(b, total, shipped=shipped):
            m = shipped.value
            ends, terms, weights = _rows(b)
            if total is None:
                total = np.zeros(m.shape, np.float32)
            for a in range(0, len(ends) - 1, ROWS):
                e = ends[a : a + ROWS + 1]
                ay = multiply(e - e[0], terms[e[0] : e[-1]], weights[e[0] : e[-1]], m)
                owner = np.repeat(np.arange(len(e) - 1), np.diff(e))
                t, w = terms[e[0] : e[-1]], weights[e[0] : e[-1]]
                order = np.argsort(t, kind="stable")
                t = t[order]
                if len(t):
                    starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
                    total[t[starts]] += np.add.reduceat(ay[owner[order]] * w[order][:, None], starts, axis=0)
            return total

        z = _add_up(sparse, n_terms, width, contribute)
        shipped.unpersist()
        if i < passes - 1:
            y = np.linalg.qr(z)[0].astype(np.float32)
    values, u = np.linalg.eigh(y.T.astype(np.float64) @ z)
    return (y @ u[:, np.argsort(values)[::-1][:rank]]).astype(np.float32)


@dataclass
class Model:
    terms: list[str]
    weights: np.ndarray
    basis: np.ndarray  # terms x rank
    subjects: list[str]  # of each centroid
    centroids: np.ndarray  # centroids x rank, of length one


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def seed_centroids(examples: list[tuple[str, str]], terms: list[str], weights: np.ndarray, basis: np.ndarray) -> tuple[list[str], np.ndarray]:
    """A centroid for each subject and language of the examples (subject, text)."""
    index = {w: i for i, w in enumerate(terms)}
    groups: dict[tuple[str, str], list[np.ndarray]] = {}
    for subject, text in sorted(examples):
        at, v = vector(text, index, weights)
        e = v @ basis[at] if at else np.zeros(basis.shape[1], np.float32)
        n = float(np.linalg.norm(e))
        if n > 0:
            groups.setdefault((subject, guess(set(words(text))) or "other"), []).append(e / n)
    keys = sorted(groups)
    if not keys:
        return [], np.zeros((0, basis.shape[1]), np.float32)
    return [k[0] for k in keys], _unit(np.array([np.sum(groups[k], axis=0) for k in keys], np.float32))


def embed(sparse: DataFrame, basis: np.ndarray) -> DataFrame:
    """(doc_id, e binary): each row's place among the singular vectors, of length one, in half precision; a row without terms is all zero."""
    shipped = sparse.sparkSession.sparkContext.broadcast(basis)

    def run(batches):
        m = shipped.value
        for b in batches:
            e = _unit(multiply(*_rows(b), m)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in e], pa.binary())], names=["doc_id", "e"])

    return sparse.mapInArrow(run, "doc_id bigint, e binary")


def _dense(b: pa.RecordBatch, width: int) -> np.ndarray:
    """The embeddings of a batch, which all have one width, from the column's bytes as they lie."""
    column = b.column(1)
    if not len(column):
        return np.zeros((0, width), np.float32)
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], np.float16, len(column) * width, first).reshape(len(column), width).astype(np.float32)


def refine(embedded: DataFrame, seeds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Move the centroids towards the documents closest to them, over all documents."""
    c = seeds
    for i in range(rounds):
        shipped = embedded.sparkSession.sparkContext.broadcast(c)
        near = NEAR - 0.05 if i < 2 else NEAR

        def contribute(b, total, shipped=shipped, near=near):
            now = shipped.value
            e = _dense(b, now.shape[1])
            sim = e @ now.T
            best, value = sim.argmax(axis=1), sim.max(axis=1)
            if total is None:
                total = np.zeros(now.shape, np.float32)
            pull = np.zeros((len(e), len(now)), np.float32)
            ok = np.flatnonzero(value > near)
            pull[ok, best[ok]] = value[ok]
            return total + pull.T @ e

        moved = _add_up(embedded, len(c), c.shape[1], contribute)
        shipped.unpersist()
        c = _unit(seeds * SEED_WEIGHT + moved)
    return c


def assign(e: np.ndarray, subjects: list[str], c: np.ndarray) -> list[list[tuple[str, float, float]]]:
    """(subject, cosine, part) of each row of embeddings of length one: none, one or two."""
    names = sorted(set(subjects))
    of = np.array([names.index(s) for s in subjects])
    sim = e @ c.T
    first = sim.argmax(axis=1)
    value = sim.max(axis=1)
    between = (c @ c.T)[first]
    det = np.maximum(1 - between**2, 1e-6)
    # least squares on the closest centroid and one of another subject
    second = (sim - between * value[:, None]) / det
    gain = np.where((of[first][:, None] != of[None, :]) & (second > 0), second**2 * det, -1)
    other = gain.argmax(axis=1)
    rows = np.arange(len(e))
    b = second[rows, other]
    a = value - between[rows, other] * b
    part = np.where(gain[rows, other] > 0, b / np.maximum(a + b, 1e-9), 0)
    out = []
    for i in rows.tolist():
        if value[i] < NEAR:
            out.append([])
        elif part[i] >= SECOND:
            out.append([(names[of[first[i]]], float(value[i]), float(1 - part[i])), (names[of[other[i]]], float(sim[i, other[i]]), float(part[i]))])
        else:
            out.append([(names[of[first[i]]], float(value[i]), 1.0)])
    return out


def learn(documents: DataFrame, examples: DataFrame) -> tuple[Model | None, DataFrame | None]:
    """The model and the documents' embeddings. Sparse rows and embeddings are written once each and read by every pass.

    ``examples`` (subject, text) are a bounded table. Without examples or without terms there is no model.
    """
    terms, weights = choose_terms(count_terms(documents))
    seeds = [(r["subject"], r["text"]) for r in examples.where(F.col("subject").isNotNull() & F.col("text").isNotNull()).select("subject", "text").collect()]
    if not terms or not seeds:
        return None, None
    sparse = materialise(vectors(documents, terms, weights), "vectors")
    basis = singular_vectors(sparse, len(terms))
    subjects, c = seed_centroids(seeds, terms, weights, basis)
    if not subjects:
        return None, None
    embedded = materialise(embed(sparse, basis), "embeddings")
    return Model(terms, weights, basis, subjects, refine(embedded, c)), embedded


def subjects(documents: DataFrame, examples: DataFrame) -> DataFrame:
    """(doc_id, subject, score, part): one or two rows for each document that is about a subject.

    ``score`` is the cosine to the subject's centroid, ``part`` the subject's part of the document. Null, empty and
    blank texts, junk, and texts near to no subject have no row. Every document counts in the terms'
    weights, the vectors and the centroids. Repeated documents repeat their rows.
    """
    schema = "doc_id bigint, subject string, score double, part double"
    model, embedded = learn(documents, examples)
    if model is None or embedded is None:
        return documents.sparkSession.createDataFrame([], schema)
    shipped = documents.sparkSession.sparkContext.broadcast((model.subjects, model.centroids))

    def run(batches):
        labels, c = shipped.value
        for b in batches:
            found = assign(_dense(b, c.shape[1]), labels, c)
            ids = b.column(0).to_pylist()
            rows = [(i, *x) for i, own in zip(ids, found, strict=True) for x in own]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["doc_id", "subject", "score", "part"])

    return embedded.mapInArrow(run, schema)


def compare_labels(found: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(doc_id, label, label_score, subject, score, verdict): each label of a catalogue (doc, topic_or_subject_gen, topic_or_subject_score_gen) beside what the document is about.

    Labels are compared without regard to case, outer blanks and hyphen against underscore or blank. ``verdict`` is ``right``, ``wrong``,
    ``missing`` (null, blank or no subject's name), or ``unknown`` where the document has no subject found;
    ``subject`` is the label's own where it is right, else the first. A document's second catalogue row has a row of its own.
    """
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", " ")
    own = found.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("part", "score", "subject")), asc=False).alias("_s"))  # two at most
    subjects_ = found.select(plain(F.col("subject")).alias("_name")).distinct()
    labels = catalogue.where(F.col("doc").isNotNull()).select(F.col("doc").alias("doc_id"), F.col("topic_or_subject_gen").alias("label"), F.col("topic_or_subject_score_gen").cast("double").alias("label_score"))
    labels = labels.withColumn("_name", plain(F.col("label"))).join(subjects_.withColumn("_known", F.lit(True)), "_name", "left")
    both = labels.join(own, "doc_id", "left")
    hit = F.get(F.filter("_s", lambda s: plain(s["subject"]) == F.col("_name")), F.lit(0))
    first = F.coalesce(hit, F.get("_s", F.lit(0)))
    verdict = F.when(F.col("_s").isNull(), "unknown").when(F.col("_known").isNull(), "missing").when(hit.isNotNull(), "right").otherwise("wrong")
    return both.select("doc_id", "label", "label_score", first["subject"].alias("subject"), first["score"].alias("score"), verdict.alias("verdict"))


def composition(found: DataFrame) -> DataFrame:
    """(subject, documents, parts, share): the corpus by subject; a document counts by its parts, share is of all that have a subject."""
    own = found.groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.sum("part").alias("parts"))
    total = own.agg(F.sum("parts").alias("_t"))
    return own.join(F.broadcast(total)).select("subject", "documents", "parts", F.try_divide("parts", "_t").alias("share"))
