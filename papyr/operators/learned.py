"""Fitted statistics of registers: cross-validated classifiers, one-class distance, a discriminant direction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words whose relative frequencies mark a style; pairs of words never occur as one token and stand for places that are always 0.
STYLE_WORDS = (
    "the a an of to in on at by for and or but if nor so as than then that this these those what which who whom whose how why when where whence whither wherein whereby whereof "
    "is are was were be been being am have has had do does did shall will would should could can may might must not no yes it its they them their there here he she his her him we our "
    "us you your i my me one two three into onto unto upon under over about through between among against toward towards after before during since until while though although because "
    "hath doth thee thou thy ye unto hence thus therein hereof herein of_what in_what into_what by_what for_what such very more most"
).split()
# First words and first two words of questions.
OPENERS = "into of what how why who when where which can is are do does describe name explain give state".split()
PAIR_OPENERS = ("of what", "into what", "in what", "can you", "how does", "what is", "what are", "how many", "for what", "by what", "how did")


def style_features(text: Column, grams: list[str]) -> Column:
    """An array of numbers: style words per word, trigrams per trigram of the text between blanks, marks of its opening, words, mean word length, characters. Null texts give null."""
    low = F.lower(text)
    words = F.regexp_extract_all(low, F.lit("[a-z]+"), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))
    padded = F.concat(F.lit(" "), low, F.lit(" "))
    places = F.greatest(F.length(padded) - 2, F.lit(0))
    threes = F.when(places > 0, F.transform(F.sequence(F.lit(1), places), lambda i: F.substring(padded, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    shares = lambda held, every, of: F.transform(F.array(*map(F.lit, of)).cast("array<string>"), lambda x: F.size(F.filter(held, lambda y: y == x)) / every)
    marks = lambda got, of: F.transform(F.array(*map(F.lit, of)), lambda x: F.when(got == x, 1.0).otherwise(0.0))
    first, two = F.coalesce(F.get(words, F.lit(0)), F.lit("")), F.array_join(F.slice(words, F.lit(1), F.lit(2)), " ")
    letters = F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w))
    shape = F.array(F.size(words).cast("double"), F.coalesce(F.try_divide(letters, F.size(words)), F.lit(0.0)), F.length(text).cast("double"))
    parts = [shares(words, n, STYLE_WORDS), *([shares(threes, F.greatest(places, F.lit(1)), grams)] if grams else []), marks(first, OPENERS), marks(two, PAIR_OPENERS), shape]
    return F.when(text.isNotNull(), F.flatten(F.array(*parts)))


def fold(key: Column, folds: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds)).cast("int")


def cross_validated(rows: DataFrame, vec: str, label: str, key: str, folds: int = 5, l2: float = 1e-3) -> DataFrame:
    """(key, label, score): each row scored by a logistic regression fitted on the folds it isn't in. Null vectors and labels are left out."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = rows.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"), array_to_vector(vec).alias("features"), fold(F.col(key), folds).alias("_f"))
    out = None
    for f in range(folds):
        m = LogisticRegression(regParam=l2, standardization=True).fit(data.where(F.col("_f") != f))
        part = m.transform(data.where(F.col("_f") == f)).select(key, "label", vector_to_array("probability")[1].alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def moments(rows: DataFrame, vec: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) of all vectors.

    A number of tasks that goes with the cores adds up outer products batch by batch; what comes to the driver is one sum a task,
    of the size of the dimensions squared.
    """
    import pyarrow as pa

    own = rows.where(F.col(vec).isNotNull()).select(F.transform(vec, lambda x: x.cast("double")).alias("_x"))
    tasks = min(own.rdd.getNumPartitions(), 2 * own.sparkSession.sparkContext.defaultParallelism)

    def run(batches):
        n, total, outer = 0, None, None
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column(0).flatten()).reshape(b.num_rows, -1)
                n += len(x)
                total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
                outer = x.T @ x if outer is None else outer + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()]), pa.array([outer.tobytes()])], names=["n", "total", "outer"])

    sums = own.coalesce(max(tasks, 1)).mapInArrow(run, "n bigint, total binary, outer binary").collect()
    if not sums:
        return 0, np.zeros(0), np.zeros((0, 0))
    n = sum(r["n"] for r in sums)
    mean = sum(np.frombuffer(r["total"]) for r in sums) / n
    outer = sum(np.frombuffer(r["outer"]) for r in sums).reshape(len(mean), len(mean))
    return n, mean, outer / n - np.outer(mean, mean)


def one_class(rows: DataFrame, vec: str, keep: list[str], k: int = 30, ridge: float = 1e-2) -> DataFrame:
    """(keep..., distance): the Mahalanobis distance from the rows' mean in their first ``k`` principal components."""
    n, mean, cov = moments(rows, vec)
    if n == 0:
        return rows.select(*keep, F.lit(None).cast("double").alias("distance"))
    values, u = np.linalg.eigh(cov)
    at = np.argsort(values)[::-1][:k]
    basis = u[:, at] / np.sqrt(values[at] + ridge * max(values.max(), 1e-12))
    centred = F.zip_with(F.transform(vec, lambda x: x.cast("double")), F.array(*map(F.lit, mean.tolist())), lambda a, b: a - b)
    parts = [F.aggregate(F.zip_with(centred, F.array(*map(F.lit, basis[:, j].tolist())), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) for j in range(basis.shape[1])]
    return rows.where(F.col(vec).isNotNull()).select(*keep, F.sqrt(sum((p * p for p in parts), F.lit(0.0))).alias("distance"))


def discriminant(rows: DataFrame, vec: str, label: str, ridge: float = 1e-2) -> np.ndarray:
    """The direction that parts rows labelled 1 from those labelled 0: inverse pooled covariance times the difference of means."""
    n0, m0, c0 = moments(rows.where(F.col(label) == 0), vec)
    n1, m1, c1 = moments(rows.where(F.col(label) == 1), vec)
    if not n0 or not n1:
        raise ValueError("both labels must have rows")
    pooled = (n0 * c0 + n1 * c1) / (n0 + n1)
    w = np.linalg.solve(pooled + ridge * np.trace(pooled) / len(m0) * np.eye(len(m0)), m1 - m0)
    return w / np.linalg.norm(w)
