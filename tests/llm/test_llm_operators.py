"""The operators against brute force, exact round trips, and texts whose defects are put there by the test."""

from __future__ import annotations

import itertools
import os
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.functions import array as F_array
from pyspark.sql.functions import col as F_col
from pyspark.sql.functions import lit as F_lit

from papyr.llm import bpe, cutoff, defects, encoding, furniture, language, mixing, quality, queries, scan, subjects

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))


# ---- encoding of the corpus ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


ALPHABET = " \n\t'’sStTreveLlmd  aé1٣½漢.!?　 🙂\x1c\x85_<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=6))
def test_encoder_matches_library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    e = bpe.encoder(bpe.vocabulary_path())
    ids = e.encode(texts)
    assert ids == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [e.decode(x) for x in ids] == texts


def test_encoder_long_runs(reference):
    e = bpe.encoder(bpe.vocabulary_path())
    texts = ["a" * 20_000, "ab" * 3000 + "'s" * 500, " " * 5000 + "x", "=" * 4097]
    assert e.encode(texts) == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]


def test_offsets_point_at_characters():
    e = bpe.encoder(bpe.vocabulary_path())
    text = "It's a café, 漢字 🙂."
    at = e.offsets([text])[0]
    ids = e.encode([text])[0]
    assert len(at) == len(ids) and at[0] == 0 and at == sorted(at) and max(at) < len(text)


def test_scan_equals_sequential_reading():
    rng = np.random.default_rng(0)
    step, begins = bpe.automaton()
    kinds = rng.integers(0, 9, 5000).astype(np.uint8)
    state, want = bpe.S_START, []
    for i, k in enumerate(kinds):
        if begins[k, state]:
            want.append(i)
        state = step[k, state]
    assert bpe.boundaries(kinds, 64).tolist() == want


def test_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "Hello's")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_column(df, "doc_id", "text").collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) > 0
    back = bpe.decode_column(bpe.encode_column(df, "doc_id", "text"), "doc_id").collect()
    assert {r["doc_id"]: r["text"] for r in back} == {1: "", 2: "", 3: " \n", 4: "Hello's"}
    off = bpe.encode_column(df, "doc_id", "text", offsets=True).where("doc_id = 4").collect()[0]
    assert len(off["offsets"]) == len(off["ids"])


# ---- cutoffs -----------------------------------------------------------------------------------------


def test_cutoffs_against_brute_force(spark):
    rng = random.Random(5)
    data = [(f"c{rng.randint(0, 5)}", float(rng.choice([rng.randint(0, 100), 50, 50, 70]))) for _ in range(3000)] + [("c0", None), (None, 3.0), ("c1", float("nan"))]
    targets = [("c0", 80), ("c1", 1), ("c2", 100), ("c3", 33), ("c4", 0), ("none", 50), ("c5", 250)]
    got = {r["source"]: (r["cutoff"], r["kept"]) for r in cutoff.keep_fraction(spark.createDataFrame(data, "category string, score double"), spark.createDataFrame(targets, "category string, target_pct int")).collect()}
    for c, pct in targets:
        scores = sorted(s for k, s in data if k == c and s is not None and s == s)
        if not scores:
            assert c not in got
            continue
        if pct <= 0:
            assert got[c] == (int(max(scores)) + 1, 0)
            continue
        want = max(x for x in range(-1, 102) if sum(s >= x for s in scores) * 100 >= min(pct, 100) * len(scores))
        assert got[c] == (want, sum(s >= want for s in scores)), c


def test_cutoffs_of_fractional_scores(spark):
    rng = random.Random(1)
    scores = [rng.random() * 10 for _ in range(500)]
    t = cutoff.order_statistics(cutoff.score_counts(spark.createDataFrame([("a", s) for s in scores], "category string, score double"), "category", "score"), {"a": 0.37})
    want = sorted(scores, reverse=True)[185 - 1]
    assert t["a"][0] == want and t["a"][1] == 185


def test_latest_delivery_counts(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    rows = [(1, "Knowledge", 10, at), (1, " KNOWLEDGE", 90, at + dt.timedelta(1)), (2, "how-to", 5, at), (2, "how_to", 5, at), (3, None, 7, at), (4, "how_to", 101, at)]
    g = spark.createDataFrame(rows, "row_id bigint, category string, score int, ingested_at timestamp")
    t = spark.createDataFrame([("knowledge", 50), ("how_to", 100)], "category string, target_pct int")
    assert sorted(map(tuple, cutoff.graded_cutoffs(g, t).collect())) == [("how_to", 5, 1), ("knowledge", 90, 1)]


# ---- mixing ------------------------------------------------------------------------------------------


def test_water_filling():
    s = [mixing.Share("a", 0.5, 10, 2), mixing.Share("b", 0.3, 1000, 1), mixing.Share("c", 0.2, 1000, 1), mixing.Share("d", 0.0, 5, 1)]
    got = {x.source: x.allotted for x in mixing.water_fill(s, 500)}
    assert got["a"] == 20 and got["d"] == 0 and abs(got["b"] - 288) < 1e-6 and abs(got["c"] - 192) < 1e-6
    assert {x.source: x.allotted for x in mixing.water_fill(s, 1e9)} == {"a": 20, "b": 1000, "c": 1000, "d": 0}


def test_mixture(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("aabbbbbbc"), rng.randint(1, 60)) for i in range(4000)] + [(9001, None, 5), (9002, "a", 0), (9003, "z", 9)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 60, 3), ("b", 30, 1), ("c", 5, 1), ("gone", 5, 2)], "source string, target_pct int, max_repeats int")
    mixture, report = mixing.mix(sizes, targets)
    uses = Counter(r["doc_id"] for r in mixture.collect())
    cap = {"a": 3, "b": 1, "c": 1}
    by = {i: (s, n) for i, s, n in rows}
    assert all(n <= cap[by[i][0]] for i, n in uses.items()) and not {9001, 9002, 9003} & set(uses)
    got = {r["source"]: r for r in report.collect()}
    assert set(got) == {"a", "b", "c", "gone"} and got["gone"]["actual_tokens"] == 0
    for s in "abc":
        actual = sum(by[i][1] * n for i, n in uses.items() if by[i][0] == s)
        assert actual == got[s]["actual_tokens"] and abs(actual - got[s]["allotted_tokens"]) <= 60
    assert abs(sum(r["actual_pct"] for r in got.values()) - 100) < 0.01
    again, _ = mixing.mix(sizes.repartition(7), targets)
    assert Counter(r["doc_id"] for r in again.collect()) == uses


# ---- wrong encodings -----------------------------------------------------------------------------------

WORDS = "the café at noon kept its façade ; the señora and the Fräulein read “mañana” there — a naïve élite , the crêpe and the rosé".split()


def _corpus() -> list[tuple[str, str, str, str, int]]:
    out = Counter()
    for _, _, x, w, y in encoding.fragments(" ".join(WORDS)):
        out[("en", x, w, y)] += 50
    return [(*k, n) for k, n in out.items()]


@pytest.mark.parametrize("misread,written", [("cp1252", "utf-8"), ("latin-1", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"), ("cp1251", "utf-8"), ("mac_roman", "cp1252"), ("cp1251", "cp1252")])
def test_restores_what_was_misread(misread, written):
    r = encoding.Repairer(encoding.build_dictionaries(_corpus()))
    text = "the café kept its façade and the naïve élite"
    raw = text.encode(written)
    table = encoding._FROM_BYTES[misread]
    broken = "".join(chr(b) if b < 128 else table.get(b, chr(b)) for b in raw)
    assert broken != text
    new, chains, lost = r.repair(broken)
    assert new == text and chains and lost == 0


def test_twice_misread_and_partly():
    r = encoding.Repairer(encoding.build_dictionaries(_corpus()))
    twice = "the café".encode().decode("cp1252").encode().decode("cp1252")
    assert r.repair(twice)[0] == "the café"
    assert r.repair("the cafÃ© kept its façade")[0] == "the café kept its façade"


@pytest.mark.parametrize("n", [1, 9, 40, 4000])
@pytest.mark.parametrize("sep", [",", "\u00a0", "x", ""])
def test_runs_without_blanks_at_any_length(n, sep):
    """The same reading on both sides of any length: runs are cut into pieces, or read whole."""
    r = encoding.Repairer(encoding.build_dictionaries(_corpus()))
    once = lambda t: t.encode().decode("latin-1")
    word = "café" if sep else "éèê"
    text = sep.join([word] * n)
    assert r.repair(once(text))[0] == text and r.repair(once(once(text)))[0] == text
    assert "".join(encoding.pieces(once(text))) == once(text)
    mixed = f"{once(text)}-{text}"
    assert r.repair(mixed)[0] == f"{text}-{text}"


@pytest.mark.parametrize("text", ["the sign Ã was used in São Brás", "ÂME ET CHÂTEAU", "√92, which", "«bonjour»", "ποταμός", "café", "漢字 שלום 🙂", "2½-acre ¶ 50 § 7", "Answеr", "﻿The", "plain", ""])
def test_correct_text_stays(text):
    r = encoding.Repairer(encoding.build_dictionaries(_corpus()))
    assert r.repair(text) == (text, [], 0)


def test_lost_characters_are_damage():
    r = encoding.Repairer(encoding.build_dictionaries(_corpus()))
    assert r.repair("the caf� at")[0] == "the café at"
    assert r.repair("zz�q")[2] == 1
    assert r.repair(None) == (None, [], 0)


# ---- statistics ---------------------------------------------------------------------------------------------


def test_lists_tables_and_junk_lie_in_the_tails(spark):
    prose = [f"The {a} had been asked to govern the {b}, and the news of it spread quickly. It was not known before that the {b} could ever be so {c}." for a in ("captain", "farmer", "clerk", "widow", "printer") for b in ("harbour", "orchard", "ledger", "garden") for c in ("quiet", "ancient", "simple", "proper", "famous")]
    no = ["apple\nPear\nPlum of the tree\nFig\nQuince\nMedlar", "Item | 1st | 2nd\nRope | 12.50 | 7\nSail | 3.10 | 9\nMast | 1 | 2", "xq7 zv9k 83h2 kk1 pq0 zzt7 91k qv8", "{}[]<>|&%$#@!*+=" * 6]
    caps = "THE CAPTAIN HAD BEEN ASKED TO GOVERN THE HARBOUR,\nAND THE NEWS OF IT SPREAD QUICKLY TO THE FARMER."
    rows = [(f"p{i}", t) for i, t in enumerate(prose)] + [(f"n{i}", t) for i, t in enumerate(no)] + [("caps", caps), ("null", None), ("blank", " \n ")]
    df = spark.createDataFrame(rows, "rec_id string, text string")
    scored, sketched = quality.analyse(df, ["rec_id"])
    got = {r["rec_id"]: r["is_prose"] for r in scored.collect()}
    assert [k for k, v in got.items() if v is False] and {k for k, v in got.items() if v is False} == {f"n{i}" for i in range(len(no))}
    assert got["caps"] is True and got["null"] is None and got["blank"] is None
    exact = np.median([quality.units(t) and sum(u * u for u in quality.units(t)) / sum(quality.units(t)) for t in prose])
    q = next(g for g in quality.quantiles(sketched) if g["lang"] == "en")
    assert abs(q["unit_words"][quality.GRID.index(0.5)] - exact) < 0.5


def test_languages_of_few_texts_change_by_degrees(spark):
    """A language's 49th, 50th and 51st text move its scores by little: its own distributions gain weight with each."""
    base = {s: [float(i) for i, _ in enumerate(quality.GRID)] for s in quality.STATISTICS}
    own = {s: [float(i) + 8 for i, _ in enumerate(quality.GRID)] for s in quality.STATISTICS}
    df = spark.createDataFrame([("fr", *[12.0] * len(quality.STATISTICS))], "lang string, " + ", ".join(f"{s} double" for s in quality.STATISTICS))
    z = []
    for n in (0, 1, 49, 50, 51, 10**6):
        r = quality.score(df, [{"lang": "all", "texts": 10**6, **base}, {"lang": "fr", "texts": n, **own}]).collect()[0]
        z.append((r["z_unit_words"], r["pct_unit_words"]))
    assert z == sorted(z, reverse=True) and all(abs(a - b) < 0.1 * abs(z[0][0] - z[-1][0]) for (a, _), (b, _) in zip(z[2:4], z[3:5], strict=True))


def test_percentiles_in_the_tails(spark):
    q = [100.0 * g for g in quality.GRID]
    df = spark.createDataFrame([(0.05,), (0.15,), (1.2,), (50.1,), (99.95,)], "v double").select("v", quality._percentile(F_col("v"), F_array(*map(F_lit, q))).alias("p"))
    assert all(abs(r["v"] - r["p"]) <= 2.6 and (r["v"] > 2 or abs(r["v"] - r["p"]) < 0.4) for r in df.collect())


def test_given_scores(spark):
    df = spark.createDataFrame([(0.9, True), (0.9, False), (None, True), (7.0, True), (0.1, False), (0.1, None), (float("nan"), True)], "prose_score double, is_prose boolean")
    assert [r["given_fits"] for r in quality.judge_given(df, "prose_score").collect()] == [True, False, None, None, True, None, None]


def test_long_words_count():
    long_ = "donaudampfschifffahrtselektrizitätenhauptbetriebswerk"
    v = quality.Vocabulary(frozenset(), frozenset(), frozenset(quality.names([long_])))
    i = quality.STATISTICS.index("known_share")
    assert quality.statistics(f"{long_} {long_}", v)[1][i] == 1.0 and quality.statistics(f"{long_}x", v)[1][i] == 0.0


# ---- subjects --------------------------------------------------------------------------------------------------


def test_singular_vectors(spark):
    rng = np.random.default_rng(0)
    a = np.where(rng.random((300, 40)) < 0.2, rng.random((300, 40)), 0).astype(np.float32)
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(x) for x in r[np.flatnonzero(r)]]) for i, r in enumerate(a)]
    sparse = spark.createDataFrame(rows, "doc_id bigint, terms array<int>, weights array<float>")
    v = subjects.singular_vectors(sparse, 40, rank=5, passes=12)
    want = np.linalg.svd(a, full_matrices=False)[2][:5]
    assert np.allclose(np.abs(np.sum(v.T * want, axis=1)), 1, atol=1e-2)


def test_sums_in_a_tree(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, 6)).astype(np.float16)
    df = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(x)], "doc_id bigint, e binary")

    def contribute(b, total):
        s = subjects._dense(b, 6).T @ subjects._dense(b, 6)
        return s if total is None else total + s

    for n in (1, 7, 60):  # few partitions, and so many that sums are folded in groups first
        assert np.allclose(subjects._add_up(df.repartition(n), 6, 6, contribute), x.astype(np.float32).T @ x.astype(np.float32), rtol=1e-4)


def test_catalogue_labels(spark):
    found = spark.createDataFrame([(1, "natural science", 0.8, 0.7), (1, "law", 0.6, 0.3), (2, "law", 0.9, 1.0), (3, "sport", 0.9, 1.0)], "doc_id bigint, subject string, score double, part double")
    meta = spark.createDataFrame([(1, " LAW", 0.9), (2, "sport", 0.9), (2, "Law", None), (3, None, 0.1), (3, "?", 1.0), (4, "law", 0.9), (1, "Natural_Science", 2.0), (None, "law", 0.1)], "doc bigint, topic_or_subject_gen string, topic_or_subject_score_gen double")
    got = sorted((r["doc_id"], r["label"] or "", r["subject"] or "", r["verdict"]) for r in subjects.compare_labels(found, meta).collect())
    assert got == [(1, " LAW", "law", "right"), (1, "Natural_Science", "natural science", "right"), (2, "Law", "law", "right"), (2, "sport", "law", "wrong"), (3, "", "sport", "missing"), (3, "?", "sport", "missing"), (4, "law", "", "unknown")]


def test_subjects_agree_with_sound_labels(spark):
    base = f"{DATA}/sf0.01"
    got = queries.p3_found(spark, base).toPandas()
    meta = spark.read.parquet(f"{base}/doc_meta.parquet").toPandas().drop_duplicates("doc")
    label = meta.set_index("doc").topic_or_subject_gen.fillna("").str.strip().str.upper()
    names = set(got.subject)
    own: dict[int, set[str]] = {}
    for d, s in zip(got.doc_id, got.subject, strict=True):
        own.setdefault(d, set()).add(s)
    hits = [label[d] in s for d, s in own.items() if d in label.index and label[d] in names]
    # the labels are wrong for one document in six or so
    assert len(names) == 12 and np.mean(hits) > 0.75
    assert got.groupby("doc_id").size().max() <= 2


# ---- languages --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"))


@pytest.mark.parametrize(
    "text,want",
    [
        ("The captain had been asked to govern the harbour. The clerk wrote of it.", {"en"}),
        ("Le juge soutient la loi pendant plusieurs années. La loi dépasse le juge, comme chacun le sait.", {"fr"}),
        ("The captain had governed the harbour. Der Richter begleitet das Gesetz, wie ein jeder weiß.", {"en", "de"}),
        ("The señora and the Fräulein both agreed that the word “mañana” was often heard there.", {"en"}),
        ("El juez regula la ley, como todos lo saben.", {"es"}),
        ("Il giudice regola la legge per parecchi anni, come tutti sanno.", {"it"}),
        ("jqdtwxhr knfhl xxwqtspxw lpmbxwx tkcx dghmqflzp wbrbtxv gvsgjqbv", set()),
        ("12 83 77 [] {}", set()),
    ],
)
def test_languages_of_texts(model, text, want):
    assert set(language._analyse([text], model)[0][0]) == want


def test_labels():
    assert [language.label_language(x) for x in ("en_US", "FR", "German", "spa", " it ", "mul", "und", "", None, "xx", "en-GB-oed")] == ["en", "fr", "de", "es", "it", None, None, None, None, None, "en"]


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    e, t, s = rng.random((1, 4, 3)), rng.random((3, 3)), rng.random(3)
    got = language.forward_backward(e, np.array([4]), t, s)[0]
    want = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(s[path[0]] + sum(e[0, i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:], strict=False)))
        for i, y in enumerate(path):
            want[i, y] += w
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True))



def test_capitals_count_where_they_stand():
    capitals, plain = "THE CAPTAIN HAD GOVERNED THE HARBOUR FOR MANY YEARS. ", "The captain had governed the harbour for many years. "
    heading = "THE HARBOUR OF QUENBY."
    whole = lambda text: [(text[s.start : s.end].strip(), s.whole) for s in language.spans(text)[1]]
    got = whole(capitals * 50 + "\n\n" + plain * 50 + f"\n\n{heading}\n\n" + plain * 50)
    assert (heading, False) in got and got[0] == (capitals.strip(), True)
    got = whole(plain * 50 + f"\n\n{heading}\n\n" + plain * 50 + "\n\n" + capitals * 50)
    assert (heading, False) in got and got[-1] == (capitals.strip(), True)
    assert whole(capitals * 3) == [(capitals.strip(), True)] * 3 and whole(plain + heading)[1] == (heading, False)


# ---- defects ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counts(spark):
    base = f"{DATA}/sf0.1"
    return defects.learn(defects.turns_of_pairs(spark.read.parquet(f"{base}/pairs.parquet")))


@pytest.mark.parametrize(
    "q,a,want",
    [
        ("What is it?", None, ["empty"]), ("What is it?", " ​ ", ["empty"]), ("What?", "Ans.", ["empty"]), ("What?", "(no answer)", ["empty"]), ("What?", "N/A", ["empty"]), ("What?", "None whatever.", []), ("What?", "No.", []), (None, "", ["empty"]),
        ("Who governed it?", "The captain had governed the", ["truncated"]), ("Who governed it?", "The captain had gov", ["truncated"]), ("Who?", "The captain governed the harbour", []), ("Who?", "The pulley of the", ["truncated"]), ("Who?", "Harbour", []), ("Who?", "The governor altered the harbour, and…", ["truncated"]), ("Who?", "There were three: the mast, the keel, etc.", []),
        ("Who?", "I must decline to answer.", ["refusal"]), ("Who?", "I must decline the common opinion, for the pupil may govern the lesson.", []), ("Who?", "The clerk refused to answer, because the harbour had been altered.", []), ("Who?", "I cannot help thinking that the harbour was altered.", []), ("Qui ?", "Veuillez m'excuser, je ne répondrai pas.", ["refusal"]), ("Who?", "Why it is so has never been found out.", []),
        ("Why did the captain govern the harbour?", "You ask: why did the captain govern the harbour.", ["copy"]), ("Why did the captain govern the harbour?", "Why did the captain govern the harbour? Because the clerk had altered the garden.", []), ("Why did the captain govern the harbour?", "WHY DID YE CAPTAIN GOVERN THE HARBOUR", ["copy"]),
        ("What is the harbour of Quenby?", "Le juge soutient la loi pendant plusieurs années, comme chacun le sait.", ["language"]), ("Quel est le juge ?", "Le juge soutient la loi pendant plusieurs années.", []), (None, "Le juge soutient la loi pendant plusieurs années.", []),
    ],
)
def test_defects(counts, q, a, want):
    assert defects.defects(q, a, counts) == want


# Sentences of all kinds that the grammar composes.
DECLINES = [
    "I must not discuss that subject.", "I refuse to enter such a discussion, and decline your request.", "This matter cannot be discussed.", "No comment will be offered.", "You must excuse me.", "I ask to be excused.", "I beg to be excused.",
    "It would not be becoming for me to comment.", "Pray choose some other subject.", "Ask me something else.", "That is beyond what I am allowed to tell.", "It is not a thing that I care to discuss.", "It is a matter on which I prefer not to dwell.",
    "That subject is one that we shall not open.", "We can make no comment.", "I have no information on the harbour and shall not attempt a reply.", "As an artificial mind I have no view.",
    "Je ne peux pas discuter de cela.", "Je refuse de traiter ce sujet.", "Il ne m'est pas permis d'en parler.", "Veuillez m'excuser.", "Je préfère ne pas en parler.",
    "Wir können das leider nicht erörtern.", "Ich muss das leider ablehnen.", "Es ist mir nicht gestattet, das zu sagen.",
    "No puedo opinar sobre eso.", "Ruego que me disculpen.", "Non posso discutere di questo.", "Vi prego di scusarmi.",
]


@pytest.mark.parametrize("text", DECLINES)
def test_refusals(text):
    assert defects.is_refusal(text)


def test_every_derivation_is_found():
    """Random derivations of the grammar: each is parsed, and none is lost to the words that every match needs."""
    rng = random.Random(3)
    g = defects._REFUSES

    def derive(name: str, depth: int = 0) -> list[str]:
        out = []
        for kind, value, absent in rng.choice(g.rules[name] if depth < 6 else [min(g.rules[name], key=len)]):
            if kind == "gap":
                out += rng.choices(["lanterns", "quite", "harbour"], k=rng.randint(0, int(value)))
            elif absent and rng.random() < 0.5:
                continue
            else:
                out += derive(value, depth + 1) if kind == "name" else [value + rng.choice(["", "e", "en"]) if kind == "stem" else value]
        return out

    for _ in range(3000):
        words = derive("refusal")
        assert g.may_hold(words) and g.find(words) is not None, words
    for sequence in g.rules["refusal"]:
        assert g._first_of(sequence)


@pytest.mark.parametrize(
    "q,a,want",
    [
        ("Who governed it?", "I must decline to answer, since the clerk of Quenby alone is charged with the papers, and since nothing in my own keeping would be of use to a stranger at this hour of the evening.", True),
        ("Who governed it?", "I must decline to answer. The clerk of Quenby alone is charged with the papers of the harbour, and nothing in my own keeping would be of any use to a stranger at this hour.", True),
        ("Who governed it?", "A curious inquiry, sir, and one which you have put with the best of manners. We decline to enter upon this question.", True),
        ("Who governed it?", "The captain of Quenby governed the harbour for many years. I cannot say more.", False),
        ("Who governed it?", "I cannot give an opinion of my own. Yet the captain of Quenby is said to have governed the harbour.", False),
    ],
)
def test_refusals_with_reasons(q, a, want):
    assert defects.is_refusal(a, q) is want


@pytest.mark.parametrize(
    "a,want",
    [
        ("The captain governed “the harbour", True), ('The captain governed "the harbour', True), ("The captain governed «the harbour", True), ("The captain governed “the harbour”", False), ("Der Kapitän regiert „den Hafen“", False), ("Der Kapitän regiert „den Hafen", True),
        ("The captain governed “the harbour.", False), ('The captain altered a mast of 5" in the harbour', False), ("The captain governed (the harbour", True), ("The captain governed <b>the harbour", True), ("The captain governed <b>the harbour</b>", False),
        ("These were altered:\n- the harbour\n- the mast\n-", True), ("These were altered:\n1. the harbour\n2.", True), ("These were altered:\n- the harbour\n- the mast", False), ("| harbour | 3 |\n| mast | 4", True), ("| harbour | 3 |\n| mast | 4 |", False),
        ("Do this:\n```\ngovern(", True), ("Do this:\n```\ngovern(\n```", False), ("the matter was â€œsettled,â€\x9d as the captain governed the harbour", False),
    ],
)
def test_structure_tells_truncation(counts, a, want):
    assert defects.is_truncated(a, counts) is want


def test_padding_and_repetition():
    for text in ("N/A" + " " * 400, "\n" * 500 + "Ans." + "\u200b \n" * 200, "(no answer)" + "\r\n" * 300):
        assert defects.is_empty(text)
    assert not defects.is_empty("Harbour" + " " * 400) and not defects.is_empty("The captain had governed the harbour." + " " * 400)
    assert defects.is_copy("Why did the captain govern the harbour?", "Why did the captain govern the harbour? " * 9)
    q = "Why did the captain of Quenby govern the harbour and the garden for so many years, when the clerk had altered the lantern of the parlour and the news of it had spread quickly?"
    assert defects.is_copy(q, f"{q} {q} {q}") and not defects.is_copy(q, f"{q} Because the pupil had altered the common lesson before the teacher could return to Morrowick.")


def test_turns():
    t = lambda r, c: {"role": r, "content": c}
    got = list(defects.exchanges([t("system", "s"), t("user", "a"), t("assistant", "b"), t("user", "c"), t("user", "d"), t("assistant", "e"), t("assistant", "f"), t("user", "g")]))
    assert got == [("a", "b", True), ("c", None, False), ("d", "e", True), (None, "f", True), ("g", None, False)]
    assert list(defects.exchanges(None)) == []


def test_tiling_against_brute_force():
    assert defects.tiles("a b c x d e f".split(), "d e f a b c".split(), 3) == [(0, 3, 3), (4, 0, 3)]
    assert defects.open_structure("a (b [c") == ["(", "["] and defects.open_structure("```x (\n```") == [] and defects.open_structure("“a” «b") == ["«"]


# ---- scanned pages ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reader(spark):
    from pyspark.sql import functions as F

    base = f"{DATA}/sf0.1"
    texts = spark.read.parquet(f"{base}/documents.parquet").select("text").unionByName(spark.read.parquet(f"{base}/pairs.parquet").select(F.explode(F.array("q", "a")).alias("text"))).where("text is not null")
    return scan.Reader(scan.learn(texts, spark.read.parquet(f"{base}/lexicon.parquet")))


@pytest.mark.parametrize(
    "text,want",
    [
        ("The fchool of Quenby had been altered by the ftatue and the paffion of it.", "The school of Quenby had been altered by the statue and the passion of it."),
        ("The harbour was al-\ntered by the captain, and the news of it spread quickly.", "The harbour was altered by the captain, and the news of it spread quickly."),
        ("The harbour was alt- A TREATISE ON THE MAST. 106 ered by the captain, and the news of it spread.", "The harbour was altered by the captain, and the news of it spread."),
        ("It was altered by the\n\n— 350 —\n\ncaptain of the harbour, and the news of it spread.", "It was altered by the captain of the harbour, and the news of it spread."),
        ("Whаt do you understand by tbe quеstion of the harbour and the captain?", "What do you understand by the question of the harbour and the captain?"),
        ("The execut0r had been gi1ded by the w!dow of the harbour.", "The executor had been gilded by the widow of the harbour."),
        ("It had been maintai¬ ned by the captain of the harbour.", "It had been maintained by the captain of the harbour."),
    ],
)
def test_repairs(reader, text, want):
    f = scan.repair(text, reader)
    assert f.any and f.text == want


@pytest.mark.parametrize("text", ["The wind- and water-mills were shut that day, with two- or three-fold advantage.", "In the year 1857 the inscription read ÂME ET CHÂTEAU in capitals, and no more.", "THE HARBOUR\n\nThe captain had governed it for many years, and the news of it spread.", "It was known before\n1857. The captain had governed the harbour.", "Rope-\nSail\nMast", None, "", "The price was £3 1s. 4d. and no less, for the captain."])
def test_sound_text_stays(reader, text):
    f = scan.repair(text, reader)
    assert not f.any and f.text == text


@pytest.mark.parametrize(
    "text,want",
    [
        ("The captain had governed the harbour\nfor many years, and the news of it\nspread quickly.\n\nThe clerk altered\nthe garden.", "The captain had governed the harbour for many years, and the news of it spread quickly.\n\nThe clerk altered the garden."),
        ("The harbour was\r\naltered.", "The harbour was altered."),
        ("Le juge soutient la loi\ndÃ©jÃ\xa0 pendant plusieurs années.", "Le juge soutient la loi dÃ©jÃ\xa0 pendant plusieurs années."),
    ],
)
def test_sound_prose_flows(reader, text, want):
    f = scan.repair(text, reader)
    assert not f.any and f.text == want


@pytest.mark.parametrize("text", ["rope\nsail\nmast", "a. mast;\nb. keel of the ship;\nc. sail;\nd. rope and mast;\ne. harbour", "| Mast | 946 |\n| Keel | 178 |\n| Sail | 3.56 |\n| Rope | 12 |", "xq zrt vvk\nqqw zzx kkj\nxxz qqk wwv\nzzk vvx qqj", "The captain had governed it.\n\nThe clerk altered the garden."])
def test_lists_tables_junk_keep_lines(reader, text):
    assert scan.repair(text, reader).text == text


def test_skip_gram_finds_company():
    rng = np.random.default_rng(0)
    words, contexts = 6, 6
    x = np.zeros((words, contexts))
    x[:3, :3], x[3:, 3:] = 50, 50
    at = np.flatnonzero(x.reshape(-1))
    w, _ = scan.skip_gram(at, x.reshape(-1)[at], words, contexts, steps=60)
    v = w / np.linalg.norm(w, axis=1, keepdims=True)
    s = v @ v.T
    assert s[:3, :3].mean() > s[:3, 3:].mean() + 0.5
    assert rng is not None


@pytest.mark.parametrize("header", ["Zweites Buch, Seite 0.", "* The Annals of Quenby *", "§ HISTORIA NATURALIS · 0", "~ livre premier ~"])
def test_headers_of_any_form_are_learned(spark, header):
    """Headers in forms and languages that no pattern names: they are known by where they stand."""
    line = "the captain had been asked to govern the harbour and to\nkeep the lantern by night, for the news of it had been\nspread by the clerk of the garden to all who came."
    texts = [f"At first {line}\n" + "\n".join(f"In {w} of the same year the boats were brought into the\n{header.replace('0', str(40 + k))}\nharbour and made fast, as had been the custom of the\nplace. {line.capitalize()}" for w in ("May", "June")) + "\nThere it ended." for k in range(6)]
    forms = furniture.learn(spark.createDataFrame([(t,) for t in texts], "text string"))
    for k, t in enumerate(texts):
        body, n = furniture.without_furniture(t, forms)
        assert n == 2 and header.replace("0", str(40 + k)) not in body and body.count("harbour and made fast") == 2


def test_lines_that_return_within_a_text():
    page = "\n".join(f"the captain had been asked to govern the harbour on day {i}\nand to keep the lantern by night, as was the custom\nof the place for many a year before" for i in range(3))
    text = "\n".join(f"{page}\nthe history of the decline of the harbour {k}" for k in range(12, 18)) + "\nand there it ended."
    body, n = furniture.without_furniture(text, furniture.Forms())
    assert n == 6 and "decline" not in body
    assert furniture.without_furniture("\n".join(f"line {i} of the song\nfa la la" for i in range(9)), furniture.Forms())[1] == 0


def test_no_correction_without_evidence():
    ids = {"the": 0, "ship": 1}
    words = scan.Words({"the": 900, "ship": 90, "harbour": 2, "sailor": 5000}, ids, np.eye(2, scan.DIMENSIONS, dtype=np.float32), np.eye(2, scan.DIMENSIONS, dtype=np.float32))
    r = scan.Reader(words)
    assert r.best("harb0ur", {"harbour": 1}, [])[1] < 0 and r.best("harb0ur", {"harbour": 1}, [0])[1] < 0  # no vector, and hardly known
    assert r.best("failor", {"sailor": 1}, [])[1] < 0  # frequent, but nothing beside it


def test_readings_at_any_length():
    long_ = "".join("abdefghk"[i % 8] for i in range(60))
    g = scan.Glyphs({long_: 3, "possessiveness": 4, "minimum": 2})
    assert g.readings(long_.replace("h", "b", 1)) == {long_: 1}
    assert g.readings("poffeffivenefs") == {"possessiveness": 1} and g.readings("poffeffivenefs".replace("n", "u")) == {"possessiveness": 2}
    assert g.readings("rninirnurn") == {} and g.readings("rninirnum") == {"minimum": 2} and g.readings("minimum") == {}


def test_more_words_than_vectors(spark, monkeypatch):
    """Recall where the vocabulary is ten times the trained vectors: the others are folded in."""
    from pyspark.sql import functions as F

    base = f"{DATA}/sf0.01"
    texts = spark.read.parquet(f"{base}/documents.parquet").select("text").unionByName(spark.read.parquet(f"{base}/pairs.parquet").select(F.explode(F.array("q", "a")).alias("text"))).where("text is not null")
    lexicon = spark.read.parquet(f"{base}/lexicon.parquet")
    rows = [r[0] for r in texts.collect()]
    found = []
    for n in (scan.VECTOR_WORDS, 200):
        monkeypatch.setattr(scan, "VECTOR_WORDS", n)
        reader = scan.Reader(scan.learn(texts, lexicon))
        assert len(reader.words.ids) > 10 * 200
        found.append({i for i, t in enumerate(rows) if scan.repair(t, reader).misread})
    assert len(found[0] & found[1]) >= 0.97 * max(map(len, found))


def test_more_forms_and_rare_words_than_tasks_hold(spark, monkeypatch):
    """The same texts come out however few forms and rare words the tasks hold: the others are asked for."""
    base = f"{DATA}/sf0.01"

    def repaired():
        return sorted((tuple(r) for r in queries.p4_repaired(spark, base).collect()), key=repr)

    whole = repaired()
    assert sum(r[3] for r in whole) > 100 and sum(r[5] for r in whole) > 100
    monkeypatch.setattr(furniture, "FORMS", 20)
    assert repaired() == whole
    monkeypatch.setattr(scan, "RARE_WORDS", 50)
    assert repaired() == whole


def test_trusted_words_have_no_bound_but_their_share(spark):
    """All words that occur often enough are trusted, and words of the lexicon keep their counts, however many others are more frequent."""
    words = ["".join(x) for x in itertools.islice(itertools.product("akopswxyz", repeat=6), 60_500)]
    texts = [(" ".join(words[i : i + 500]),) for i in range(0, len(words), 500)] * 6 + [("harbour",)] * 3
    learned = scan.learn(spark.createDataFrame(texts, "text string"), spark.createDataFrame([("harbour",), ("anchor",)], "word string"))
    assert learned.counts == {w: 6 for w in words} | {"harbour": 3, "anchor": 1}
    last = max(w for w in words if w.endswith("s"))
    assert scan.Reader(learned).status(last[:-1] + "f") == ("maybe", {last: 1})


def test_keys_beyond_the_filter_are_none(spark):
    from papyr.llm import rest

    asker = rest.Asker(rest.filter_of(spark.createDataFrame([(f"wÿ{i}",) for i in range(5000)], "key string")))
    assert all(asker.may_hold(f"wÿ{i}") for i in range(5000)) and sum(asker.may_hold(f"x{i}") for i in range(5000)) < 50
    asker.begin({"wÿ1": (3, b""), "wÿ2": None})
    assert asker.get("wÿ1") == (3, b"") and asker.get("wÿ2") is None and asker.get("wÿ3") is None and asker.asked == {"wÿ3"}
