"""Packing, reply checks, verdicts, sources, sinks and the incremental harvest."""

from __future__ import annotations

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from papyr.passes import ledger, provider, verdicts
from papyr.sources import files
from papyr.streaming import ingest


def test_ledger(spark):
    led = spark.createDataFrame([("p", "a", "1", 1), ("p", "a", "2", 2), ("q", "b", "x", 1), ("p", None, "z", 9)], ledger.SCHEMA)
    df = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert rows(ledger.latest(led, "p")) == [("a", "2")]
    assert {r[0] for r in ledger.pending(df, "key", led, "p").collect()} == {"b", None}
    assert {(r["key"], r["payload"]) for r in ledger.with_verdict(df, "key", led, "p").collect()} == {("a", "2"), ("b", None), (None, None)}


@pytest.mark.parametrize("body,want", [("[87, 92]", [87, 92]), ("[87, true]", None), ("[87, 101]", None), ("[87, 92.5]", None), ("see [1,2]", None), ("```\n[1, 0]\n```", [1, 0]), ("[]", []), (None, None)])
def test_integer_array(spark, body, want):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(verdicts.integer_array(F.col("b"), 0, 100)).collect()[0][0] == want


def test_asking_and_halving(spark):
    df = spark.createDataFrame([(f"k{i}", i, "d") for i in range(4)], "key string, i int, dataset string")
    asked = verdicts.requests(df, "key", F.lit("x" * 40), "dataset", "i", 1000)
    short = provider.Replay(spark.createDataFrame([("d/0", "[1,0,1]")], "batch_id string, body string")).replies(asked)
    none = verdicts.by_position(asked, short, verdicts.integer_array(F.col("body"), 0, 1))
    assert none.count() == 0
    again = verdicts.unresolved(asked, none)
    assert sorted((r["batch_id"], r["pos"]) for r in again.collect()) == [("d/0.0", 0), ("d/0.0", 1), ("d/0.1", 0), ("d/0.1", 1)]
    ruled = provider.Rule(lambda r: F.col("pos") % 2).replies(again)
    assert rows(verdicts.by_position(again, ruled, verdicts.integer_array(F.col("body"), 0, 1))) == [("k0", 0), ("k1", 1), ("k2", 0), ("k3", 1)]
    objects = spark.createDataFrame([("d/0", 'so: [{"i":0,"q":"x"},{"i":9,"q":"y"},{"i":0,"q":"z"}]')], "batch_id string, body string")
    assert [(r["key"], r["r"]["q"]) for r in verdicts.by_index(asked, objects, "q:string").collect()] == [("k0", "z")]


def test_bleed(spark):
    df = spark.createDataFrame([("not json",), ('{"pairs":[]}',), ('{"pairs":[{"q":"x","a":""}]}',), ('{"pairs":[{"q":"x","a":"y"},{"q":"","a":"z"}]}',), ('{"status":"discard"}',)], "b string")
    got = [(r[0]["status"], len(r[0]["pairs"])) for r in df.select(verdicts.bleed_verdict(F.col("b"), F.lit("q"), F.lit("a"))).collect()]
    assert got == [("clean", 1), ("discard", 0), ("discard", 0), ("pairs", 1), ("discard", 0)]


def test_ocr_and_flags(spark):
    kind = "dataset string, i int, q string, a string, r struct<q:string,a:string,discard:boolean,flagged:boolean>"
    df = spark.createDataFrame([("d", 0, "q", "a", None), ("d", 1, "q", "a", ("q2", None, None, None)), ("d", 2, "q", "a", (None, None, True, None)), ("d", 3, "q" * 9000, "a", None)], kind)
    assert rows(verdicts.apply_ocr(df).select("i", "q", "changed", "flagged")) == [(0, "q", False, True), (1, "q2", True, False)]
    df = spark.createDataFrame([("[true,false]", 3), ("[true,false,true]", 3)], "b string, n int")
    assert [r[0] for r in df.select(verdicts.dependency_flags(F.col("b"), F.col("n"))).collect()] == [[False] * 3, [True, False, True]]


def test_routes(spark):
    kind = "doc_index string, classes array<string>, prose_score double, excerpt string, affordance string"
    ex = spark.createDataFrame([("a", ["knowledge"], 0.9, "The cause is not known. It is so.", "x"), ("b", ["narrative_fiction", "narrative_grounded"], 0.9, "He ran.", "x"), ("c", ["stem_reasoning"], 0.9, "3 = = 5", "x"), ("d", None, None, "t", None)], kind)
    got = {n: sorted(r["doc_index"] for r in verdicts.sources(ex, r, 0.5).collect()) for n, r in verdicts.ROUTES.items()}
    assert got["knowledge_qa"] == ["a"] and got["narrative_fiction"] == [] and got["narrative_grounded"] == ["b"] and got["stem_reasoning"] == ["c"] and got["calibration_qa"] == ["a"]
    df = spark.createDataFrame([(["The cause is not known."], "The cause is not known. It is so."), (["It is so."], "The cause is not known. It is so.")], "s array<string>, x string")
    assert [r[0] for r in df.select(verdicts.checked_answer(verdicts.ROUTES["calibration_qa"], F.col("s"), F.col("x"))).collect()] == ["The cause is not known.", None]


def test_verify_and_grade(spark):
    r = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_index string")
    j = spark.createDataFrame([("a#0", 1), ("b#0", 1), ("b#1", 0), ("c#0", None)], "key string, value int")
    assert rows(verdicts.apply_verify(r, j)) == [("a",), ("c",)]
    m = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1), ("y", None)], "route string, value int")
    assert rows(verdicts.misaligned(m)) == [("ALL", 3, 1, pytest.approx(1 / 3, abs=1e-6)), ("x", 2, 1, 0.5), ("y", 1, 0, 0.0)]
    g = verdicts.apply_grade(spark.createDataFrame([(95,), (None,)], "s int"), F.col("s"), F.array(F.lit("unbalanced parentheses"))).collect()
    assert [(x["score"], x["publish"]) for x in g] == [(40, True), (None, False)]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "logic.json").write_text(json.dumps([{"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, {"conversations": [{"role": "user", "content": "q"}]}]))
    got = files.json_rows(spark, str(tmp_path / "in"), files.TURNS, lines=False).withColumn("i", F.lit(0))
    assert rows(files.pairs_of_conversations(got)) == [("logic", 0, "q", "a")]
    (tmp_path / "book.txt").write_text("one\n\ntwo")
    assert rows(files.whole_texts(spark, str(tmp_path / "book.txt"))) == [("book", "one\n\ntwo")]
    files.write_sharded(spark.range(25), str(tmp_path / "out"), "id", 10)
    files.compact(spark, str(tmp_path / "out"), str(tmp_path / "even"), "id bigint", "id", 10)
    assert spark.read.json(str(tmp_path / "even")).count() == 25


def test_sinks_and_migration(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, n int")
    files.write_by_dataset(df, str(tmp_path / "by"))
    assert sorted((r["dataset"], r["n"]) for r in spark.read.json(str(tmp_path / "by")).select("dataset", "n").collect()) == [("a", 1), ("b", 2)]


def test_locate(spark):
    m = files.offsets(spark.createDataFrame([(0, 3), (1, 2), (2, 4)], "index int, num_docs long"))
    got = files.locate(spark.createDataFrame([(3,), (8,), (99,)], "n long"), "n", m)
    assert {r["n"]: (r["shard"], r["local"]) for r in got.collect()} == {3: (1, 0), 8: (2, 3), 99: (None, None)}


def test_harvest_appends_once(spark, tmp_path):
    src, pool, ck = (str(tmp_path / x) for x in ("src", "pool", "ck"))
    spark.createDataFrame([("a", "t"), ("b", "t")], "doc_index string, text string").write.parquet(src)
    run = lambda c: ingest.harvest(spark, src, "doc_index string, text string", pool, c, lambda d: d).awaitTermination()
    run(ck)
    spark.createDataFrame([("c", "t")], "doc_index string, text string").write.mode("append").parquet(src)
    run(ck)
    assert sorted(r["doc_index"] for r in spark.read.parquet(pool).collect()) == ["a", "b", "c"]
    run(str(tmp_path / "other"))
    assert spark.read.parquet(pool).count() == 3


def test_scratch_folder(spark, monkeypatch):
    from pathlib import Path

    from papyr import session

    assert session.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    session.drop_scratch(spark)
    df = session.materialise(spark.range(3), "t")
    left = lambda: [p for p in Path(session.scratch_dir(spark)).glob("papyr-t-*")]
    assert df.count() == 3 and len(left()) == 1
    assert session.drop_scratch(spark) == 1 and left() == [] and session.drop_scratch(spark) == 0


@pytest.mark.parametrize("master,fine", [("local[4]", True), ("local-cluster[2,1,1024]", False), ("spark://host:7077", False), ("yarn", False)])
def test_no_local_folder_on_a_cluster(master, fine):
    from types import SimpleNamespace as Bag

    from papyr import session

    held = {}
    context = Bag(master=master, getConf=lambda: Bag(get=lambda k, d: d), getCheckpointDir=lambda: held.get("dir"), setCheckpointDir=lambda d: held.update(dir=d))
    bare = Bag(conf=Bag(get=lambda k, d: d), sparkContext=context)
    if fine:
        assert session.scratch_dir(bare) == held["dir"]
    else:
        with pytest.raises(ValueError):
            session.scratch_dir(bare)
