"""Golden cases of the row-level functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from papyr.functions import normalise as N
from papyr.functions import repair as R
from papyr.functions import signals as S

WORDS = frozenset("afterwards parliament the most some of these must serve school spoke same see said sing passion house first set experiment horizontal rod cone coun".split())


def one(spark, text, fn, kind="string"):
    df = spark.createDataFrame([(text,)], f"t {kind}")
    return df.select(fn(F.col("t")).alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(
    "fn,text,want",
    [
        (S.strip_lines, "THE HISTORY OF ROME\n42\nxiv\n* See note\n---\n\nThe city fell.", "\nThe city fell."),
        (S.is_self_contained, "This was so.", False), (S.is_self_contained, "The war ended.", True), (S.is_self_contained, None, None),
        (S.has_affordance, "Name ....... Age ....", False), (S.has_affordance, "A.. b", True),
        (S.gibberish_ratio, "97en the brtk cat", 0.5), (S.gibberish_ratio, "", 0.0),
        (S.has_broken_math, "3 = = 5", True), (S.has_broken_math, "3 + 2 = 5", False),
        (S.has_calibration_hedge, "The cause of the disease is not known.", True), (S.has_calibration_hedge, "an unknown quantity", False),
        (S.garbage_ratio, "a\nb", 1 / 3), (S.turn_rule, "Written. Played.", "notation"), (S.turn_rule, "i t r m 1 so", "fingering"), (S.turn_rule, "All is well here.", None),
        (S.notation_count, "H2O 1776 x^2 20th well-known Boyle's —", 3), (S.foreign_count, "漢字​ café", 3),
        (S.sentences, "He came.  She went! “No” (A) So.", ["He came.", "She went! “No” (A) So."]), (S.sentences, "  ", []),
        (S.affordance_label, "Know all men by these presents that I am he.", "composition"), (S.affordance_label, "Firstly, take the bread.", "procedural"), (S.affordance_label, "I think we ought to go.", "opinion"), (S.affordance_label, "It is so because it is.", "argument"), (S.affordance_label, "A plain text.", "expository"),
        (S.stem_signal, "if then", 0.0), (S.is_structured_dialogue, "Q. What? A. That. Q. Why?", True), (S.is_structured_dialogue, "He said no.", False),
        (N.map_characters, "Cæsar—“ſhall”", 'Caesar--"shall"'), (N.map_characters, "⅘", "4/5"), (N.strip_controls, "a​b\n\tc\x07", "ab\n\tc"),
        (N.fix_confusables, "vοlume λόγος", "volume λόγος"), (N.ends_mid_word, "the most ter-", True), (N.ends_mid_word, "the end.", False),
        (N.word_tokens, "It's 2 o'Clock", ["it", "s", "o", "clock"]), (N.mojibake_count, "cafÃ© �", 2), (N.is_template, " What is it", True),
        (N.reply_array, '```json\n[{"i":0}]\n```', '[{"i":0}]'), (N.reply_array, "noise [1,2] tail", "[1,2]"), (lambda c: N.reply_array(c, True), "noise [1,2] tail", None),
    ],
)
def test_golden(spark, fn, text, want):
    got = one(spark, text, fn)
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_nulls_give_nulls(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for fn in (S.region_quality, S.gibberish_ratio, S.ocr_score, S.narrative_signal, S.stem_signal, S.conversational_signal, S.affordance_label, N.normalise, S.strip_lines):
        assert df.select(fn(F.col("t")).alias("v")).collect()[0]["v"] is None


def test_spans(spark):
    rows = [("The winds blow.  They are  steady.", ["they are steady;"]), ("The winds blow.", ["no"]), ("a b c", ["a", "b", "c"]), ("a", None)]
    df = spark.createDataFrame(rows, "x string, s array<string>")
    assert [r[0] for r in df.select(N.locate_spans(F.col("s"), F.col("x"))).collect()] == ["They are steady", None, None, None]
    df = spark.createDataFrame([("of CuSO,+Zn here", [("CuSO,+Zn", "CuSO₄ + Zn")]), ("of CuSO,+Zn here", [("CuSO,+Zn", "CuSO4 and Zn")])], "x string, s array<struct<verbatim:string,refurbished:string>>")
    assert [r[0] for r in df.select(N.refurbished_spans(F.col("s"), F.col("x"))).collect()] == ["CuSO₄ + Zn", None]
    df = spark.createDataFrame([("a rose\nis red", ["rose is red"]), ("a (rose)\nis", ["(rose) is"])], "x string, s array<string>")
    assert [r[0] for r in df.select(N.verse_spans(F.col("s"), F.col("x"))).collect()] == ["rose\nis red", "(rose)\nis"]


def test_split_numbered(spark):
    rows = [("What is A? It is x. 91. What is B? It is y. 92. What is C?", "It is z."), ("What is A? 91. What is B?", "z"), ("What is A?", "z")]
    df = spark.createDataFrame(rows, "q string, a string")
    got = [r[0] for r in df.select(N.split_numbered(F.col("q"), F.col("a"))).collect()]
    assert [tuple(x) for x in got[0]] == [("What is A?", "It is x."), ("What is B?", "It is y."), ("What is C?", "It is z.")]
    assert got[1] is None and got[2] is None


def test_overlap(spark):
    df = spark.createDataFrame([("trade winds", "winds blow")], "q string, a string")
    assert tuple(df.select(N.echo(F.col("q"), F.col("a")), N.jaccard(F.col("q"), F.col("a"))).collect()[0]) == (0.5, pytest.approx(1 / 3))


def test_hyphens():
    mended = lambda t: R.mend_hyphens(t, WORDS)
    assert mended("after- wards") == ("afterwards", {"plain": 1}) and mended("rod- and cone") == ("rod- and cone", {})
    assert mended("par- 21. CHAP. liament") == ("parliament", {"furniture": 1}) and mended("par- 1 2 3 4 5 liament")[1] == {}
    assert mended("Lieutenant- Governor")[0] == "Lieutenant-Governor" and mended("anti- Roman rod- Roman") == ("anti-Roman rod- Roman", {"compound": 1})
    assert mended("(par- 21. CHAP. liament) sat\nafter-\n  wards, ter-") == ("(parliament) sat\nafterwards, ter-", {"furniture": 1, "plain": 1})
    assert R.lost_fragments("exa- as they Exa- as rod- and", WORDS) == ["exa- as"] and mended("") == ("", {})
    assert R.split_words("an expe riment in parlia ment, of par, liament", WORDS | {"experiment"}) == ["expe riment", "parlia ment"]


def test_long_s():
    text = "fome of thefe muft ferve the fchool"
    assert dict(R.long_s(text, WORDS)) == {"fome": "some", "thefe": "these", "muft": "must", "ferve": "serve", "fchool": "school"}
    assert R.long_s("said Keefer of Fowle", WORDS) == [] and R.long_s("fome", WORDS) == [] and R.long_s("fome ſ", WORDS) == [("fome", "some")]
    assert R.mend(text, WORDS) == "some of these must serve the school"
    assert R.homoglyphs("vοlume λόγος") == [("vοlume", "volume")]
    assert R.homoglyphs("ϲannot ѕchool ofһer vοlumе") == [("ϲannot", "cannot"), ("ѕchool", "school"), ("ofһer", "ofher")]
    hit = "fome thefe fhould fhall muft moft firft juft himfelf caufe becaufe prefent againft wifh fuch paffed".split()
    true = frozenset("some these should shall must most first just himself cause because present against wish such passed flows lifted failed favour favoured fewer flashed fearing fainted wafted soft often left first fast use of no sort than".split())
    assert len({w for w, _ in R.long_s(" ".join(hit), true)}) == len(hit)
    assert R.long_s("flows lifted failed favour favoured fewer flashed fearing fainted wafted soft often left first fast", true, False) == []
    assert R.long_s("Rufe was grave. I never saw him hurried.", true) == [] and len(R.long_s("Make ufe of no other Sort than thefe, while we ufe them.", true)) == 3


def test_inflected(spark):
    got = {r["word"] for r in R.inflected(spark.createDataFrame([("favor",), ("run",), ("happy",), ("realize",)], "word string")).collect()}
    assert {"favoured", "running", "happily", "realised", "thou"} <= got
    with pytest.raises(ValueError):
        R.Lexicon(spark, [])


def test_clean_rows(spark):
    lex = R.Lexicon(spark, WORDS)
    df = spark.createDataFrame([("a", "after- wards the most"), ("b", "the most ter-"), ("c", None), ("d", "")], "k string, answer string")
    got = {r["k"]: (r["answer"], r["keep"], r["joined"]) for r in R.clean_rows(df, ["answer"], lex).collect()}
    assert got == {"a": ("afterwards the most", True, 1), "b": ("the most ter-", False, 0), "c": (None, True, 0), "d": ("", True, 0)}


def test_notation_turns_and_variants(spark):
    from papyr.operators import generate

    df = spark.createDataFrame([(["H2O", "is", "20th"], [1.0, 2.0, 3.0], [3, 2, 4])], "w array<string>, b array<double>, s array<int>")
    got = df.select(S.mask_notation(F.col("w"), F.col("b"), F.col("s")).alias("m")).collect()[0]["m"]
    assert (got["words"], got["bits"], got["bytes"]) == (["is", "20th"], [2.0, 3.0], [2, 4])
    df = spark.createDataFrame([([("user", "Cæsar—so"), ("assistant", None)],)], "c array<struct<role:string,content:string>>")
    assert [tuple(t) for t in df.select(N.normalise_turns(F.col("c")).alias("c")).collect()[0]["c"]] == [("user", "Caesar--so"), ("assistant", None)]
    q = spark.createDataFrame([("k", "Who?", None)], "doc_index string, question string, conversations array<struct<role:string,content:string>>")
    c = spark.createDataFrame([("m", None, [("user", "a"), ("assistant", "b"), ("user", "c")])], q.schema)
    every = generate.build_all(q, c, spark.createDataFrame([("x", 1)], "doc_index string, extra int"))
    assert sorted((r["id"], r["text"]) for r in generate.scoring_input(every).collect()) == [("k", "Who?"), ("m#0", "a"), ("m#2", "c")]
    v = spark.createDataFrame([("1", "t", "old", " ", None)], "id string, type string, q_vintage string, q_modern string, q_authentic string")
    assert [tuple(r) for r in generate.variants(v).collect()] == [("1", "t", "vintage", "old")]
