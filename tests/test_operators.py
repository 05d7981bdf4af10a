"""Golden cases of sequences, windows, samples, statistics, extractors and generators."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from papyr.functions import repair
from papyr.functions import signals as S
from papyr.operators import extract, generate, sampling, sequence, stats, windows


def pairs(spark, n, **extra):
    return spark.createDataFrame([("d", i, f"q{i}", f"a{i}") for i in range(n)], "dataset string, i int, q string, a string")


@pytest.mark.parametrize("flags,want", [([False, True, False, True, True], [[0, 1], [2, 3, 4]]), ([True, False], [[0], [1]]), ([None, None], [[0], [1]])])
def test_chains(spark, flags, want):
    df = spark.createDataFrame([("d", i, "q", "a", f) for i, f in enumerate(flags)], "dataset string, i int, q string, a string, depends boolean")
    got = {}
    for r in sequence.chains(df.repartition(5)).collect():
        got.setdefault(r["chain"], []).append(r["i"])
    assert sorted(map(sorted, got.values())) == want
    conv = sequence.conversations(sequence.chains(df)).orderBy("chain").collect()
    assert [len(r["conversations"]) for r in conv] == [2 * len(x) for x in want] and [r["chained"] for r in conv] == [len(x) > 1 for x in want]


def test_attach(spark):
    status = ["bare", "clear", "bare", "bare", "ambiguous", "bare"]
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(status)], "dataset string, i int, status string")
    assert [r["output"] for r in sequence.attach(df).orderBy("i").collect()] == [0, 1, 1, 1, 2, 2]


def test_pair_windows(spark):
    got = sequence.pair_windows(pairs(spark, 120), 50).orderBy("i").collect()
    assert [sum(r["w"] == w for r in got) for w in range(3)] == [50, 50, 20]
    assert got[0]["context"] is None and got[60]["context"]["q"] == "q49" and got[119]["context"]["q"] == "q99"


def test_greedy_batches(spark):
    rng = random.Random(0)
    sizes = {g: [rng.randint(0, 9) for _ in range(40)] for g in "ab"} | {"c": [5, 4, 3, 9]}
    df = spark.createDataFrame([(g, i, s) for g, xs in sizes.items() for i, s in enumerate(xs)], "g string, i int, s int")
    got = {}
    for r in sequence.greedy_batches(df.repartition(7), "s", 8, "g", "i", 5).orderBy("g", "i").collect():
        got.setdefault(r["g"], []).append(r["batch"])
    for g, xs in sizes.items():
        want, cur, n, b = [], 0, 0, 0
        for s in xs:
            if n and (cur + s > 8 or n >= 5):
                cur, n, b = 0, 0, b + 1
            cur, n = cur + s, n + 1
            want.append(b)
        assert got[g] == want
    assert got["c"] == [0, 1, 1, 2]


@pytest.mark.parametrize("budget,most", [(30, None), (8, 5), (0, None), (10**6, 7), (10**6, None)])
def test_batches_over_many_ranges(spark, budget, most):
    """One group holds nearly all rows and spans all ranges, with runs of zeros, items beyond the budget, nulls and a null group."""
    rng = random.Random(budget)
    sizes = {"hot": [rng.choice([0, 0, 1, 3, 9, 50, None]) for _ in range(900)], "b": [9] * 7, None: [2, None, 8]}
    df = spark.createDataFrame([(g, i, s) for g, xs in sizes.items() for i, s in enumerate(xs)], "g string, i int, s int")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {(r["g"], r["i"]): r["batch"] for r in sequence.greedy_batches(df, "s", budget, "g", "i", most).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == df.count()
    for g, xs in sizes.items():
        cur, n, b = 0, 0, 0
        for i, s in enumerate(xs):
            if n and (cur + (s or 0) > budget or n >= (most or 10**9)):
                cur, n, b = 0, 0, b + 1
            cur, n = cur + (s or 0), n + 1
            assert got[g, i] == b


def test_islands_over_many_ranges(spark):
    rng = random.Random(4)
    flags = [rng.choice([True, True, True, False, None]) for _ in range(500)]
    df = spark.createDataFrame([("d", i, f"q{i}", f"a{i}", f) for i, f in enumerate(flags)] + [(None, 3, "q", "a", True)], "dataset string, i int, q string, a string, depends boolean")
    got = {r["i"]: r["chain"] for r in sequence.chains(df).where("dataset = 'd'").collect()}
    want, c = {}, -1
    for i, f in enumerate(flags):
        c += 1 if i == 0 or not f else 0
        want[i] = c
    assert got == want and [r["chain"] for r in sequence.chains(df).where("dataset is null").collect()] == [0]
    w = {r["i"]: (r["w"], r["pos"], r["context"] and r["context"]["q"]) for r in sequence.pair_windows(df.where("dataset = 'd'"), 7).collect()}
    assert w == {i: (i // 7, i % 7, None if i < 7 else f"q{i // 7 * 7 - 1}") for i in range(500)}


def test_attached_turns_merge(spark):
    rows = [("d", 0, "clear", [("user", "q0"), ("assistant", "a0")], False, None), ("d", 1, "bare", [("user", "q1")], None, True), ("d", 2, None, None, True, False)]
    df = spark.createDataFrame(rows, "dataset string, i int, status string, conversations array<struct<role:string,content:string>>, chained boolean, enriched boolean")
    got = sequence.merge_attached(sequence.attach(df)).orderBy("i").collect()
    assert [([t["content"] for t in r["conversations"]], r["chained"], r["enriched"]) for r in got] == [(["q0", "a0", "q1"], True, True), ([], True, False)]


def test_turns(spark):
    t = [("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2"), ("assistant", "x")]
    df = spark.createDataFrame([(t, [True] * 5)], "c array<struct<role:string,content:string>>, ok array<boolean>")
    got = df.select(sequence.with_history(F.col("c")).alias("h"), sequence.alternating_prefix(F.transform("c", lambda x: x["role"])).alias("n"), sequence.opening_stretch(F.col("c"), F.col("ok")).alias("o"), sequence.as_text(F.col("c")).alias("t")).collect()[0]
    assert got["n"] == 4 and len(got["o"]) == 4 and got["h"][0]["question"] == "u1" and got["h"][1]["question"] == "User: u1\nAssistant: a1\nUser: u2" and got["t"].startswith("USER: u1\nASSISTANT: a1")
    ver = df.select(sequence.exchanges_kept(F.col("c"), F.array(*map(F.lit, [True, True, True, False, True])), F.lit(3)).alias("a"), sequence.exchanges_kept(F.col("c"), F.array(*[F.lit(True)] * 5), F.lit(1)).alias("b")).collect()[0]
    assert ver["a"] is None and len(ver["b"]) == 2


def test_dialogue(spark):
    say = lambda *xs: [(x,) for x in xs]
    cases = [
        say("“Where is the boat tonight?”", "It lies in the harbour,", "Is it far?", "It is a long way off—"), say("Yes, it is so.", "It lies there.", "Is it far?", "It is a long way."), say("Where is it?", "It lies in the harbour.", "He said it was far.", "It is a long way."),
        say("Where is it?", "I dunno where it lies.", "Is it far?", "It is a long way."), say("Where is Brandt?", "It lies there now.", "Is it far?", "It is long."), None,
    ]
    df = spark.createDataFrame([(c,) for c in cases], "l array<struct<text:string>>")
    got = [r[0] and [x["content"] for x in r[0]] for r in df.select(sequence.dialogue(F.col("l"), S.name_pattern(["Mr. Brandt", "The Captain", None]))).collect()]
    assert got == [["Where is the boat tonight?", "It lies in the harbour.", "Is it far?", "It is a long way off."], None, None, None, None, None]
    df = spark.createDataFrame([("God save you.",), ("Brandt's way.",), ("Current indicator.",), ("Come, sir.",)], "t string")
    assert [r[0] for r in df.select(S.is_speechlike(F.col("t"))).collect()] == [True, False, False, False]


def test_ranked_cuts(spark):
    for n, k in ((20, 1), (19, 0)):
        df = spark.createDataFrame([(i, float(i % 7)) for i in range(n)] + [(99, None)], "i int, s double")
        got = [r["i"] for r in sequence.ranked_cut(df, "s", 0.05, "i").where("dropped").collect()]
        assert got == [0][:k]
    df = spark.createDataFrame([(0, 3.0), (1, 3.0), (2, 1.0), (3, None), (4, 0.5)], "i int, s double")
    assert [r["i"] for r in sequence.top_fraction_drop(df, "s", 0.25, "i").where("dropped").collect()] == [0]


def test_two_party_runs(spark):
    df = spark.createDataFrame([("b", i, s, f"t{i}") for i, s in enumerate("ABABCB")], "book string, pos int, speaker string, text string")
    got = sequence.two_party_runs(df).collect()
    assert len(got) == 1 and [x["speaker"] for x in got[0]["turns"]] == list("ABAB")


def test_primary_class(spark):
    df = spark.createDataFrame([(["knowledge", "verse"],), ([],), (None,)], "c array<string>")
    assert [r[0] for r in df.select(sequence.primary_class(F.col("c"), stats.CLAIM_ORDER)).collect()] == ["verse", "drop", "drop"]


def test_disjoint(spark):
    df = spark.createDataFrame([([(0.9, 0, 3), (0.8, 2, 5), (0.7, 5, 8)],)], "c array<struct<score:double,a:int,b:int>>")
    got = df.select(windows.greedy_disjoint(F.col("c"), 2)).collect()[0][0]
    assert [(x["a"], x["b"]) for x in got] == [(0, 3), (5, 8)]


def test_windows_keep_their_promises(spark):
    base = "It is commonly said that the engine had been altered by the master of the works, and the news of it was known to all who were there. "
    text = base * 60 + "Therefore the ratio of the angle is equal to the product, since the force and the pressure of the oxygen are equal. " * 20
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    for fn in (lambda d: windows.prose_windows(d, "doc_id", ["doc_id"], words=60), lambda d: windows.stem_windows(d, ["doc_id"])):
        got = fn(df).collect()
        assert got and {r["doc_id"] for r in got} == {1} and rows(fn(df.repartition(3))) == rows(fn(df))
        spans = sorted((r["first"], r["last"]) for r in got)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(windows.prose_excerpt(df, "doc_id", ["doc_id"]).collect()) == 1
    verse = "\n".join(f"A line of verse that ends in {w}" for w in ("day way say may lay ray bay hay jay clay pray stay " * 2).split()[:15])
    got = windows.verse_windows(spark.createDataFrame([(1, verse)], "doc_id int, text string"), ["doc_id"]).collect()
    assert len(got) == 1 and got[0]["score"] == 1.0 and got[0]["excerpt"].count("\n") == 11


def _window_texts():
    base = "It is commonly said that the engine had been altered by the master of the works, and the news of it was known to all who were there. "
    odd = [
        base, base.upper(), "“He said,” replied the king of the isle, “that they had ſeen 12 ships and xxxx b4 in the year 1745 of the bay.” ", "Table ...... 14 of the things that were there .... 15 and of the rest. ", "一二三 of the and \uff21 \ufffd in it. ",
        "Whereas the defendant, aforesaid, had walked to wit and talked, since he asked for it to be paid in the hall of the town. ", "These were the things that he had. ", "Thus 1a 2b 3c 4d. \"It was\" said. ",
    ]
    rng = random.Random(7)
    mixed = ["".join(rng.choice(odd) for _ in range(n)) for n in (1, 2, 3, 5, 8, 13, 40, 90)]
    return [base * 80, base * 3, base.upper() * 30, "", " \n\t", "x", *mixed, *["\n".join(m.split(". ")) for m in mixed], "No stop at all " * 300]


@pytest.mark.parametrize("words,floor,k", [(None, 0.7, 3), (None, 0.0, 3), (60, 0.5, 4), (1, 0.3, 2)])
def test_prose_windows_are_the_first_of_all_tries(spark, words, floor, k):
    def u(purpose, key, t):
        return int(hashlib.md5(f"0:{purpose}:{key}:{t}".encode()).hexdigest()[:8], 16) / 2**32

    df = spark.createDataFrame(list(enumerate(_window_texts())), "doc_id int, text string")
    tries = []
    for d in df.select("doc_id", S.sentences(S.strip_lines(F.col("text"))).alias("units")).collect():
        sizes = [len(x.split(" ")) for x in d["units"]]
        lo = min(len(sizes) // 10, len(sizes) - 1)
        for t in range(1, k * 10 + 1) if sizes else ():
            key, band = d["doc_id"], u("band", d["doc_id"], t)
            a = b = lo + int(u("start", key, t) * (len(sizes) - lo))
            n = words or [120 + int(u("words", key, t) * 61), 300 + int(u("words", key, t) * 151), 550 + int(u("words", key, t) * 251)][(band >= 0.40) + (band >= 0.75)]
            while b < len(sizes) and sum(sizes[a:b]) < n:
                b += 1
            tries.append((key, t, a, b, " ".join(d["units"][a:b])))
    c = F.col("text")
    judged = spark.createDataFrame(tries, "doc_id int, t int, a int, b int, text string").select("*", (S.is_self_contained(c) & (S.count(c, S.LEADER) < 2) & ~S.is_garbage(c) & (S.region_quality(c) >= floor)).alias("good"), F.bround(S.region_quality(c), 3).alias("score"), S.affordance_label(c).alias("label"))
    want = {}
    for r in sorted(judged.collect(), key=lambda r: (r["doc_id"], r["t"])):
        kept = want.setdefault(r["doc_id"], [])
        if r["good"] and len(kept) < k and all(r["a"] >= x[1] or r["b"] <= x[0] for x in kept):
            kept.append((r["a"], r["b"], r["score"], r["label"], r["text"]))
    got = {}
    for r in windows.prose_windows(df, "doc_id", ["doc_id"], k=k, floor=floor, words=words).orderBy("doc_id", "n").collect():
        got.setdefault(r["doc_id"], []).append(tuple(r[x] for x in ("first", "last", "score", "affordance", "excerpt")))
        assert r["n"] == len(got[r["doc_id"]]) - 1
    assert got == {key: x for key, x in want.items() if x} and len({x[3] for w in got.values() for x in w}) > 1


def test_prose_windows_judge_no_text_thirty_times(spark):
    """Thirty tries in a text of a few sentences are few windows: they cost no more than some judgements of the whole text."""
    texts = [x for x in _window_texts() if 200 < len(x) < 1500]
    df = spark.range(2000, numPartitions=4).select(F.col("id").alias("doc_id"), F.element_at(F.array(*[F.lit(x) for x in texts]), (F.col("id") % len(texts) + 1).cast("int")).alias("text")).cache()
    assert df.count() == 2000
    c = F.col("text")

    def seconds(q):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            q.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        return min(took)

    once = seconds(df.select(S.is_self_contained(c), S.has_affordance(c), S.is_garbage(c), S.region_quality(c), S.affordance_label(c)))
    assert seconds(windows.prose_windows(df, "doc_id", ["doc_id"])) < 4 * once
    df.unpersist()


def test_quotas(spark):
    df = spark.createDataFrame([("x", 100), ("y", 25), ("z", 4), ("o", 0)], "category string, n long")
    assert {r["category"]: r["quota"] for r in sampling.tempered_quotas(df, 34).collect()} == {"x": 20, "y": 10, "z": 4, "o": 0}
    assert {r["category"]: r["quota"] for r in sampling.tempered_quotas(df, 17).collect()} == {"x": 10, "y": 5, "z": 2, "o": 0}


def test_slices_and_samples(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    got = sampling.two_slices(df, "k").collect()
    assert sum(r["in_first"] for r in got) == 9 and sum(r["in_second"] for r in got) == 14 and sum(r["in_first"] and r["in_second"] for r in got) == 3
    assert rows(sampling.sample(df, 5, "k", 1)) == rows(sampling.sample(df.repartition(9), 5, "k", 1))
    same = spark.createDataFrame([(1, "x"), (2, "x")], "k int, answer string")
    assert sampling.mismatched(same, "k").count() == 0


def test_percentiles(spark):
    df = spark.createDataFrame([("g", v) for v in (10, 20, 30, 40)], "g string, v int")
    assert stats.exact_percentiles(df, ["g"], "v", {"p": 0.5}).collect()[0]["p"] == 20
    assert stats.exact_percentiles(df, ["g"], "v", {"p": 0.5}, False).collect()[0]["p"] == 30


def test_scores(spark):
    df = spark.createDataFrame([(10, None)], "ocr int, rest int")
    assert df.select(stats.weighted_score({"ocr": 1, "rest": 4})).collect()[0][0] == 6.0
    df = spark.createDataFrame([(["unbalanced parentheses", "answer appears to end mid-sentence or mid-structure"],), ([],), (None,)], "w array<string>")
    assert [r[0] for r in df.select(stats.warning_cap(F.col("w"))).collect()] == [40, 100, 100]
    df = spark.createDataFrame([("q", "a (b", "knowledge_qa"), ("q", "one, two:", "x"), ("what is the one two three four five", "one two three four five", "knowledge_qa"), (None, None, "x")], "q string, a string, r string")
    got = [r[0] for r in df.select(stats.warnings(F.col("q"), F.col("a"), F.col("r"))).collect()]
    assert got == [["unbalanced parentheses"], ["answer appears to end mid-sentence or mid-structure"], ["the question contains the answer proposition"], []]
    lex = repair.Lexicon(spark, ["parliament", "experiment", "the", "sat"])
    df = spark.createDataFrame([("q", "the parlia ment sat\n", "x"), (" \n Comprehend: q", "one;\n ", "narrative_fiction"), ("q", "a (expe riment", "x")], "q string, a string, r string")
    got = [r[0] for r in df.select(stats.warnings(F.col("q"), F.col("a"), F.col("r"), lex)).collect()]
    assert got == [["probable OCR-split words: parlia ment"], ["answer appears to end mid-sentence or mid-structure", "meta prompt prefix: Comprehend"], ["unbalanced parentheses", "probable OCR-split words: expe riment"]]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in got], "w array<string>").select(stats.warning_cap(F.col("w"))).collect()] == [55, 60, 40]


def test_auc_and_vectors(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.4, 0), (3, 0.35, 1), (4, 0.8, 1)], "k int, s double, y int")
    assert stats.rank_auc(df, "s", "y", "k").collect()[0][0] == 0.75
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [2.0, 2.0])], "g string, v array<double>")
    assert {r["g"]: r["centroid"] for r in stats.centroids(v, "g", "v").collect()} == {"a": [0.5, 0.5], "b": [2.0, 2.0]}
    assert stats.variance_shares(v, "g", "v").collect()[0]["share"] == pytest.approx(0.75)
    q = spark.createDataFrame([("what made the winds blow", "tell what made the winds cease")], "s string, a string")
    assert q.select(stats.longest_shared_run(F.col("s"), F.col("a"))).collect()[0][0] == pytest.approx(4 / 5)


BOOKS = {
    "brewers_guide": ("Q. What is ale?\n\nA, A drink\nof malt.\n\nQ. And beer?\n\nA. The same.", [("What is ale?", "A drink of malt."), ("And beer?", "The same.")]),
    "astronomy": ("THE MOON\n\nQ. 1. What is it? A. The light of night.\n\nQ. 2. How far?\n\n* A. Very far.", [("What is it?", "The light of night."), ("How far?", "Very far.")]),
    "chemistry": ("Q,, What is sul-\nphur? A, A solid.\n\nGt. And gas?\n\nA. None.", [("What is sulphur?", "A solid."), ("And gas?", "None.")]),
    "new_york_bar": ("I Q. What is a deed? A, A writing.\n\n•Q. And a will?\n\nA. Another.", [("What is a deed?", "A writing."), ("And a will?", "Another.")]),
    "school_bulletin": ("1. What is a verb?\n\nAns.—A word of action.\n\n2. And a noun?\n\nAns. A name.", [("What is a verb?", "A word of action."), ("And a noun?", "A name.")]),
    "grammar": ("Preface.\n\nQUESTIONS AND ANSWERS\n\n^; What is it .^^ A: A thing.\n\nSI; And then? ^: More.", [("What is it?", "A thing."), ("And then?", "More.")]),
    "logic": ("Q,  What  is  it?\nA. A rule.\n\nO. And then?\n\nJ. More. Q, Why?\n\nAi. So.", [("What is it?", "A rule."), ("And then?", "More."), ("Why?", "So.")]),
    "patriotism": ("Q. What is it?\n\n-4. A flag.", [("What is it?", "A flag.")]),
    "botany": ("noise\n\nQ. 1. What is it?\n_A. A leaf.\n@. And then?\n\nA. A stem.", [("What is it?", "A leaf."), ("And then?", "A stem.")]),
    "ethics": (".28. Q. What is it?\nA, A duty.\n~29. Q. Why?\n\nA. So.", [("What is it?", "A duty."), ("Why?", "So.")]),
    "constitution": ("<£. What is it? A. A law.\n\n12\n\nq. Who?\n\nJl. They.", [("What is it?", "A law."), ("Who?", "They.")]),
    "engineering": ("Q. What is it?\n\nA. A part of\n\n12 roper's catechism for\n\nthe engine. Q. Why? A. So.", [("What is it?", "A part of the engine."), ("Why?", "So.")]),
    "symbological": ("Question 1.\n\nQ. What is it?\n\nA. A sign. 4 Q. Why?\n\nA. So.", [("What is it?", "A sign."), ("Why?", "So.")]),
    "seeleys": ("1. What is it? A thing.\n\n2. Not a question.\n\n3. Why? So? Yes.", [("What is it?", "A thing."), ("Why?", "So? Yes.")]),
    "mythology": ("(1) Who was he?\n\nA god.\n\n(2) And she? Another.", [("Who was he?", "A god."), ("And she?", "Another.")]),
    "laborers": ("Front.\n\nWhat is toil? It is work.\n\nLESSON II\n\nWho toils? All do.", [("What is toil?", "It is work."), ("Who toils?", "All do.")]),
    "common_core": ("1. What is it? Is it so? Yes.\n2. And then? No.", [("What is it? Is it so?", "Yes."), ("And then?", "No.")]),
    "music": ("What is a note?\n\nA sound\nof music.\n\nAnd a rest?\n\nSilence.", [("What is a note?", "A sound of music."), ("And a rest?", "Silence.")]),
    "familiar_things": ("What is tea?\n\nA leaf.\n\nWhat is salt?\n\nA stone.\nINDEX.\nmore?", [("What is tea?", "A leaf."), ("What is salt?", "A stone.")]),
    "investors": ("Index\nWhat is a BOND ? A promise.\nWhat is a SHARE ?\n\nA part.", [("What is a bond ?", "A promise."), ("What is a share ?", "A part.")]),
    "civil_war": ("Q. — Who fought?\n\nA. — The armies.\n\nQuestions and Answers\n\nQ. — Why?\n\nA. - So.", [("Who fought?", "The armies."), ("Why?", "So.")]),
    "stokers": ("1. Question.—What [8] is it?\n\nAnswer.—A fire.\n\n2. Question.—Why?\n\nAnswer.—So.", [("What is it?", "A fire."), ("Why?", "So.")]),
    "world_history": ("1. Q. Who ruled? A. The king.\n\n12\n\n2. Q,. Why?\n\nA, So.", [("Who ruled?", "The king."), ("Why?", "So.")]),
    "advanced_questions": ("1. What is it?\n\nAns. — A thing.\n\nDime Question Books.\n\nMore of it.\n\nNote.—no.\n\n2. Why? An?.— So.", [("What is it?", "A thing. More of it."), ("Why?", "So.")]),
    "advanced_questions+": ("1. What?\n\nNote.—first.\n\nAns.—One.\n\nAns.—Two.\n\n3.\n\nAns.—Three.\n\n4. Who? Ans.— He.\n\nA HEADING\nOF TWO\nAND THREE LINES\n\nChemistry. 26", [("What?", "One."), ("Who?", "He. A HEADING OF TWO AND THREE LINES")]),
}


@pytest.mark.parametrize("name", list(extract.NAMES))
def test_extractors(spark, name):
    text, want = BOOKS.get(name, BOOKS.get({"electricity": "seeleys", "agriculture": "common_core", "1001_questions": "common_core"}.get(name, ""), ("", [])))
    df = spark.createDataFrame([("b", text), ("null", None), ("empty", "")], "book string, text string")
    got = [(r["q"], r["a"]) for r in extract.extract(df, "text", name, ["book"]).orderBy("i").collect()]
    assert got == want
    if f"{name}+" in BOOKS:
        text, want = BOOKS[f"{name}+"]
        df = spark.createDataFrame([("b", text)], "book string, text string")
        assert [(r["q"], r["a"]) for r in extract.extract(df, "text", name, ["book"]).orderBy("i").collect()] == want


def test_generators(spark):
    s = ["When the tide had turned the captain gave the order to weigh anchor.", "What reason can be given for the colour of the sky?"]
    d, i = ["I do not follow you", "there is no such word", "I cannot tell what you mean"], ["what do you mean", "pray say it again"]
    a, b = (generate.unparseable(spark, 120, s, d, i).collect() for _ in range(2))
    assert a == b and len(a) == 120 == len({r["question"] for r in a})
    assert not any("no such word" in r["answer"].lower() for r in a if r["input_class"] in ("fragment", "bare_punctuation"))
    assert not any("what you mean" in r["answer"] and "do you mean" in r["answer"] for r in a)
    q = spark.createDataFrame([(f"k{n}", f"What is the chief reason for {w} here?") for n, w in enumerate(("gravity", "parliament", "magnetism", "commerce", "religion") * 4)], "k string, q string").dropDuplicates(["q"])
    t = generate.typos(q, 50, "k", "q").collect()
    assert t and all(r["mangled_word"] in r["question"] and r["correct_word"].lower() in r["answer"].lower() and len(r["mangled_word"]) >= 3 for r in t)
    e = generate.era(spark, 3, {"date": (["What year is it?"], ["It is 1930.", "The year 1930."]), "location": (["Where?"], ["Here."])}).collect()
    assert len(e) == 3 == len({(r["question"], r["answer"]) for r in e})
    c = generate.clauses(spark.createDataFrame([("Good day, sir. good day, sir.",), ("Good day, sir",)], "t string"), "t", {"g": "(?i)(good day, sir)"}, [], 2).collect()
    assert [(r["clause"], r["n"]) for r in c] == [("good day, sir", 3)]
