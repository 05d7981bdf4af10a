"""Passes from request to row, vocabulary checks and reports."""

from __future__ import annotations

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from papyr.operators import reports, vocabulary
from papyr.passes import assembly, verdicts


class Says:
    """A provider that answers each request by a function of its prompt; None leaves it out of the reply."""

    def __init__(self, fn, body=None):
        self.fn, self.body = fn, body

    def replies(self, asked):
        batches: dict[str, list] = {}
        for r in asked.orderBy("batch_id", "pos").collect():
            batches.setdefault(r["batch_id"], []).append((r["pos"], self.fn(r["prompt"])))
        got = [(b, self.body if self.body is not None else json.dumps([{"i": i, **x} for i, x in xs if x is not None])) for b, xs in batches.items()]
        return asked.sparkSession.createDataFrame(got, "batch_id string, body string")


def test_classify(spark):
    df = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "three"), ("d", None)], "k string, excerpt string")
    said = {"one": {"classes": ["verse", "nonsense"]}, "two": {"classes": ["nonsense"]}, "three": None}
    assert rows(assembly.classify(df, "k", Says(lambda p: said.get(p)))) == [("a", ["verse"])]
    assert rows(assembly.classify(df, "k", Says(lambda p: None, "no json"))) == []
    points = spark.createDataFrame([("p", n, 5) for n in range(9)] + [("q", n, max(n, 3)) for n in range(12)] + [("r", n, 1) for n in range(3)], "pass string, n int, stored int")
    assert rows(assembly.stalled(points)) == [("p",)]


def test_scored(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, t string")
    full = dict(zip(assembly.DIMENSIONS, (1, 2, 3, 4, 5), strict=True))
    assert rows(assembly.scored(df, "k", Says(lambda p: full if p == "x" else {"ocr": 9}), F.col("t"))) == [("a", 1, 2, 3, 4, 5), ("b", 9, None, None, None, None)]
    assert rows(assembly.scored(df, "k", Says(lambda p: None, "sorry"), F.col("t"))) == [("a", 5, 5, 5, 5, 5), ("b", 5, 5, 5, 5, 5)]


def test_enriched(spark):
    df = spark.createDataFrame([("d", 0, "What is it?", "ale"), ("d", 1, "And then?", "beer"), ("e", 0, "Who?", "he"), ("e", 1, "It?", "x")], "dataset string, i int, q string, a string")
    status = {"And then?": "ambiguous", "It?": "ambiguous", "Who?": "bare"}
    got = assembly.enriched(df, Says(lambda p: {"status": status[p]} if p in status else None), Says(lambda p: {"q": " What comes after ale? " if "beer" in p else " "}))
    assert rows(got.select("dataset", "i", "q", "status", "enriched")) == [("d", 0, "What is it?", "clear", False), ("d", 1, "What comes after ale?", "ambiguous", True), ("e", 0, "Who?", "bare", False), ("e", 1, "It?", "ambiguous", False)]


def test_bleed_retry(spark):
    df = spark.createDataFrame([("d", 0, "Q", "It is. 12. What is that?"), ("d", 1, "Q", "It is."), ("d", 2, "Q", "So. 3. What now?"), ("d", 3, None, None)], "dataset string, i int, q string, a string")
    assert rows(assembly.bleed_retry(df, df.where("i = 2")).select("i")) == [(0,)]


def test_routes_end_to_end(spark):
    text = "The cause of the tide is not known. The moon draws the sea."
    ex = spark.createDataFrame([(f"d{k}", "SCIENCE", 1900, text, ["knowledge"], 0.9, "x") for k in range(40)], "doc_index string, category string, year int, excerpt string, classes array<string>, prose_score double, affordance string")
    one, two = verdicts.ROUTES["knowledge_qa"], verdicts.ROUTES["calibration_qa"]
    assert assembly.pool(ex, one).count() == 18 and assembly.pool(ex, verdicts.ROUTES["multiturn_qa"]).count() == 28 and assembly.pool(ex, two).count() == 40
    got = assembly.run_route(ex, one, Says(lambda p: {"q": "What draws the sea?", "category": " TIDES ", "spans": ["the moon draws the sea"]})).collect()
    assert len(got) == 40 and {(r["question"], r["answer"], r["category"], r["book_category"]) for r in got} == {("What draws the sea?", "The moon draws the sea", "TIDES", "SCIENCE")}
    assert assembly.run_route(ex, one, Says(lambda p: {"q": "What?", "spans": ["not in the text"]})).count() == 0
    got = assembly.run_route(ex, two, Says(lambda p: {"spans": ["The cause of the tide is not known."]}), Says(lambda p: {"q": "What causes the tide?"})).collect()
    assert len(got) == 40 and {(r["question"], r["answer"], r["category"]) for r in got} == {("What causes the tide?", "The cause of the tide is not known.", "SCIENCE")}
    with pytest.raises(ValueError):
        assembly.run_route(ex, two, Says(lambda p: None))


def test_out_of_period(spark):
    told = spark.createDataFrame([("the organ systems of the world " * 3,), ("king's rare",), (None,)], "t string")
    vocab = vocabulary.period_vocabulary(vocabulary.period_counts(told, "t"))
    assert {r[0] for r in vocab.collect()} == {"the", "organ", "systems", "of", "world"}
    asked = spark.createDataFrame([(1, "The organ-systems of Quenby and the world's television-organ"), (2, "Of the world"), (3, None), (4, "Internet of internet, 'tv' it")], "k int, t string")
    assert rows(vocabulary.out_of_period(asked, "k", "t", vocab)) == [(1, ["and", "television-organ"]), (4, ["internet"])]
    hits = asked.select("k", vocabulary.barred_words(F.col("t"), ["internet", "tv"]).alias("w"), vocabulary.barred_phrases(F.col("t"), ["of the", "of internet", "the worl"]).alias("p"))
    assert rows(hits) == [(1, [], []), (2, [], ["of the"]), (3, [], []), (4, ["internet"], ["of internet"])]
    assert rows(vocabulary.scan(asked, "k", "t", ["internet"], ["of the"], vocab)) == [("out_of_period", 2, 4, 50.0), ("phrases", 1, 4, 25.0), ("words", 1, 4, 25.0)]
    assert rows(vocabulary.scan(asked.limit(0), "k", "t", [], [])) == [("phrases", 0, 0, 0.0), ("words", 0, 0, 0.0)]


def test_reports(spark):
    meta = spark.createDataFrame([("a", 0.4, 1900, 10), ("a", 0.8, None, 30), ("a", None, 1910, 20), (None, 0.9, 1800, None)], "c string, conf double, y int, n int")
    assert rows(reports.category_profile(meta, "c", "conf", "y", "n").select("c", "documents", "confidence_min", "suspect", "year_min", "year_max", "confidence_p50", "year_p50", "size_p50", "size_p90")) == [("a", 3, 0.4, 1, 1900, 1910, 0.4, 1900, 20, 20), (None, 1, 0.9, 0, 1800, 1800, 0.9, 1800, None, None)]
    ex = spark.createDataFrame([("Firstly, take the bread.", "expository"), ("A plain text.", "expository"), (None, "opinion")], "excerpt string, affordance string")
    assert rows(reports.relabel_delta(reports.relabel(ex))) == [("expository", "procedural", 1), ("opinion", None, 1)]
    g = spark.createDataFrame([("r", 90, []), ("r", 40, ["unbalanced parentheses"]), ("r", 80, ["meta prompt prefix: Comprehend"]), ("r", 70, None), ("r", None, ["x"])], "route string, score int, warnings array<string>")
    got = {r["subset"]: (r["n"], r["mean"], r["median"], r["low"], r["high"], r["below50"]) for r in reports.grade_analysis(g, "route").collect()}
    assert got == {"all": (4, 70.0, 75.0, 40, 90, 1), "clean": (2, 80.0, 80.0, 70, 90, 0), "flagged": (2, 60.0, 60.0, 40, 80, 1), "capped": (1, 40.0, 40.0, 40, 40, 1)}
    assert rows(reports.warning_histogram(g, "route")) == [("r", "meta prompt prefix", 1), ("r", "unbalanced parentheses", 1)]
    j = spark.createDataFrame([("m", 5, 4), ("m", 2, 5), ("m", None, 5)], "model string, answered int, period int")
    assert rows(reports.judge_summary(j, "model")) == [("m", 2, 3.5, 4.5, 0.5, 0.5, 0.0)]
