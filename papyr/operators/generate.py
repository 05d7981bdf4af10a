"""Constructed rows: unparseable input, typing errors, questions of era, mined clauses. Deterministic in (count, seed).

Every draw hashes (seed, row number, purpose), so rows are made side by side and need no shared generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyr.functions import signals as S
from papyr.operators.sampling import weighted_choice
from papyr.operators.windows import draw, fragment

VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxz"
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
# Kinds of unparseable input, weighed by how hard they are.
INPUT_CLASSES = {"fragment": 34, "single_nonword": 16, "multi_token": 16, "consonant_run": 9, "keyboard_mash": 6, "long_run": 5, "micro": 4, "alnum_noise": 4, "mixed_case": 3, "repeated_char": 2, "bare_punctuation": 1}
# Neighbouring keys.
NEIGHBOURS = {
    "a": "qwsz", "b": "vghn", "c": "xdfv", "d": "serfcx", "e": "wsdr", "f": "drtgvc", "g": "ftyhbv", "h": "gyujnb", "i": "ujko", "j": "huikmn", "k": "jiolm", "l": "kop", "m": "njk",
    "n": "bhjm", "o": "iklp", "p": "ol", "q": "wa", "r": "edft", "s": "awedxz", "t": "rfgy", "u": "yhji", "v": "cfgb", "w": "qase", "x": "zsdc", "y": "tghu", "z": "asx",
}
SOUNDS = (("ee", "ea"), ("ea", "ee"), ("ie", "ei"), ("ei", "ie"), ("ph", "f"), ("ck", "k"), ("ou", "oo"), ("tion", "shun"))
CONFIRMATIONS = ("You mean %s, I take it?", "You mean %s, correct?", "%s, I suppose you mean?", "Do you mean %s?", "I take that for %s. Have I it right?", "You will mean %s, surely?", "Is it %s you are asking after?", "%s, if I read you rightly?", "I read that as %s. Is that your meaning?", "Do I take you to mean %s?")
ERA_KINDS = {"date": 72, "identity": 11, "anachronism": 11, "location": 6}


def _u(n: Column, purpose: str, seed: int) -> Column:
    return draw(n, purpose, None, seed)


def _upto(u: Column, low: int, high: int) -> Column:
    """A whole number from low to high."""
    return (low + F.floor(u * (high - low + 1))).cast("int")


def _pick(chars: str, u: Column) -> Column:
    return F.substring(F.lit(chars), _upto(u, 1, len(chars)), F.lit(1))


def _letters(n: Column, length: Column, purpose: str, seed: int, chars: str, every_third: str = "") -> Column:
    """``length`` drawn characters; each third one from ``every_third``, if given."""

    def one(i: Column) -> Column:
        u = draw(n, purpose, i, seed)
        c = _pick(chars, u)
        return F.when(i % 3 == 1, _pick(every_third, u)).otherwise(c) if every_third else c

    return F.array_join(F.transform(F.sequence(F.lit(1), length), one), "")


def nonsense(kind: Column, n: Column, seed: int, sentence: Column) -> Column:
    """Input of a kind for row ``n``; fragments are cut from ``sentence``."""
    u = lambda p: _u(n, p, seed)
    run = _letters(n, _upto(u("run"), 6, 12), "run-c", seed, CONSONANTS, VOWELS)
    row = F.element_at(F.array(*map(F.lit, KEY_ROWS)), _upto(u("row"), 1, 3))
    first = (1 + F.floor(u("start") * (F.greatest(F.length(row) - 6, F.lit(0)) + 1))).cast("int")  # the longer the row, the more places
    span = F.substring(row, first, _upto(u("span"), 4, 8))

    def token(k: Column) -> Column:
        tiny = (k > 1) & (draw(n, "tiny", k, seed) < 0.4)
        size = F.when(tiny, _upto(draw(n, "tiny-n", k, seed), 1, 2)).otherwise(_upto(draw(n, "size", k, seed), 4, 13))
        t = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.when(i % 3 == 1, _pick(VOWELS, draw(n, "tok", k * 100 + i, seed))).otherwise(_pick(CONSONANTS, draw(n, "tok", k * 100 + i, seed)))), "")
        case = draw(n, "case", k, seed)
        return F.when(case < 0.35, F.initcap(t)).when(case < 0.45, F.upper(t)).otherwise(t)

    mixed = F.array_join(F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c, i: F.when(draw(n, "upper", i, seed) < 0.5, F.upper(c)).otherwise(c)), "")
    return (
        F.when(kind == "fragment", fragment(sentence, n, seed))
        .when(kind == "single_nonword", F.concat(*[_pick(s, u(f"w{i}")) for i, s in enumerate((CONSONANTS, VOWELS, CONSONANTS, VOWELS + CONSONANTS, CONSONANTS))]))
        .when(kind == "multi_token", F.array_join(F.transform(F.sequence(F.lit(1), _upto(u("tokens"), 2, 4)), token), " "))
        .when(kind == "consonant_run", run)
        .when(kind == "keyboard_mash", F.when(u("back") < 0.7, span).otherwise(F.reverse(span)))
        .when(kind == "long_run", _letters(n, _upto(u("long"), 18, 45), "long-c", seed, CONSONANTS + VOWELS))
        .when(kind == "micro", _letters(n, _upto(u("micro"), 1, 3), "micro-c", seed, CONSONANTS + VOWELS))
        .when(kind == "alnum_noise", _letters(n, _upto(u("alnum"), 5, 10), "alnum-c", seed, "abcdefghijklmnopqrstuvwxyz0123456789"))
        .when(kind == "mixed_case", mixed)
        .when(kind == "repeated_char", F.repeat(_pick("abcdefghijklmnopqrstuvwxyz", u("char")), _upto(u("times"), 5, 14)))
        .otherwise(F.element_at(F.array(*map(F.lit, ("?", "??", "???", "...", "-", ".", "!?", ",,"))), _upto(u("punct"), 1, 8)))
    )


def sentence_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1_000_000))


def deflection(kind: Column, n: Column, seed: int, deflections: list[str], invitations: list[str]) -> Column:
    """An answer joined from clauses: a deflection that suits the kind, and in 55 percent of cases an invitation, unless both speak of meaning."""
    word_only = [d for d in deflections if "no such word" in d or "never heard the word" in d]
    general = [d for d in deflections if d not in word_only] or deflections
    one = lambda xs, p: F.element_at(F.array(*map(F.lit, xs)), _upto(_u(n, p, seed), 1, len(xs)))
    body = F.when(kind.isin("fragment", "bare_punctuation"), one(general, "deflect")).otherwise(one(deflections, "deflect"))
    if not invitations:
        return F.concat(sentence_case(body), F.lit("."))
    plain = [i for i in invitations if "mean" not in i]
    invite = F.when(F.contains(body, F.lit("mean")), one(plain, "invite") if plain else F.lit(None)).otherwise(one(invitations, "invite"))
    joiner = one([" -- ", ". ", "; "], "joiner")
    tail = F.when(joiner == ". ", sentence_case(invite)).otherwise(invite)
    end = F.when(S.has(F.lower(invite), "^(?:what|how)"), "?").otherwise(F.when(_u(n, "end", seed) < 0.5, ".").otherwise("?"))
    both = F.concat(sentence_case(body), joiner, tail, end)
    return F.when((_u(n, "invites", seed) < 0.55) & invite.isNotNull(), both).otherwise(F.concat(sentence_case(body), F.lit(".")))


def _finish(rows: DataFrame, route: str, count: int, *distinct: str) -> DataFrame:
    """The first ``count`` rows with new questions, in the order of their numbers."""
    first = rows.groupBy(*distinct).agg(F.min_by(F.struct(*rows.columns), "n").alias("r")).select("r.*")
    return first.orderBy("n").limit(count).select(F.format_string(f"robust-{route}-%05d", F.col("n")).alias("doc_index"), F.lit(route).alias("category"), F.lit("ROBUSTNESS").alias("book_category"), *[c for c in rows.columns if c != "n"], F.lit(100).alias("score"))


def unparseable(spark: SparkSession, count: int, sentences: list[str], deflections: list[str], invitations: list[str], seed: int = 1930, attempts: int = 4) -> DataFrame:
    """``count`` rows (doc_index, ..., input_class, question, answer, score), distinct by question. The pools are small lists of clauses and sentences."""
    n = F.col("n")
    base = spark.range(count * attempts).select(F.col("id").alias("n"))
    kind = weighted_choice(_u(n, "class", seed), INPUT_CLASSES)
    sentence = F.element_at(F.array(*map(F.lit, sentences)), _upto(_u(n, "sentence", seed), 1, len(sentences)))
    rows = base.withColumn("input_class", kind).withColumn("question", nonsense(F.col("input_class"), n, seed, sentence)).withColumn("answer", deflection(F.col("input_class"), n, seed, deflections, invitations))
    return _finish(rows.where(F.col("question").isNotNull() & (F.col("question") != "")), "unparseable", count, "question")


def mangle(word: Column, op: Column, n: Column, seed: int) -> Column:
    """A word with a typing error: drop, swap, double, neighbour or sound; a drop where the other doesn't apply."""
    size = F.length(word)
    cut = lambda a, b: F.substring(word, a, b)
    at = lambda purpose, low, high: (low + F.floor(_u(n, purpose, seed) * (high - low + 1))).cast("int")
    i = at("drop", F.lit(2), size)
    dropped = F.concat(cut(F.lit(1), i - 1), cut(i + 1, size))
    j = at("swap", F.lit(1), size - 1)
    swapped = F.concat(cut(F.lit(1), j - 1), cut(j + 1, F.lit(1)), cut(j, F.lit(1)), cut(j + 2, size))
    k = at("double", F.lit(1), size)
    doubled = F.concat(cut(F.lit(1), k), cut(k, size))
    keys = F.create_map(*[F.lit(x) for kv in NEIGHBOURS.items() for x in kv])
    m = at("key", F.lit(1), size)
    near = F.try_element_at(keys, F.lower(cut(m, F.lit(1))))
    beside = F.concat(cut(F.lit(1), m - 1), F.substring(near, (1 + F.floor(_u(n, "near", seed) * F.length(near))).cast("int"), F.lit(1)), cut(m + 1, size))
    sound = F.lit(None).cast("string")
    for a, b in reversed(SOUNDS):
        p = F.locate(a, F.lower(word))
        sound = F.when(p > 0, F.concat(cut(F.lit(1), p - 1), F.lit(b), cut(p + len(a), size))).otherwise(sound)
    return F.when(op == "swap", swapped).when(op == "double", doubled).when(op == "neighbour", F.coalesce(beside, dropped)).when(op == "sound", F.coalesce(sound, dropped)).otherwise(dropped)


def typos(questions: DataFrame, count: int, key: str, text: str, seed: int = 1930) -> DataFrame:
    """``count`` rows of questions with one content word mistyped, and an answer that names the word.

    Errors that change nothing, leave fewer than three letters, or leave the question as it was, give no row.
    """
    n = F.xxhash64(F.col(key))
    words = S.content_words(F.col(text))
    q = questions.withColumn("n", n).withColumn("_w", words).where(F.size("_w") > 0)
    word = F.regexp_replace(F.try_element_at(F.col("_w"), (1 + F.floor(_u(F.col("n"), "word", seed) * F.size("_w"))).cast("int")), r"^[^A-Za-z]+|[^A-Za-z]+$", "")
    op = F.element_at(F.array(*map(F.lit, ("drop", "swap", "double", "neighbour", "sound"))), _upto(_u(F.col("n"), "op", seed), 1, 5))
    rows = q.withColumn("correct_word", word).withColumn("mangled_word", mangle(F.col("correct_word"), op, F.col("n"), seed))
    rows = rows.withColumn("question", F.replace(F.col(text), F.col("correct_word"), F.col("mangled_word")))
    good = rows.where((F.col("mangled_word") != F.col("correct_word")) & (F.length("mangled_word") >= 3) & (F.col("question") != F.col(text)))
    confirm = F.element_at(F.array(*map(F.lit, CONFIRMATIONS)), _upto(_u(F.col("n"), "confirm", seed), 1, len(CONFIRMATIONS)))
    said = F.when(F.startswith(confirm, F.lit("%s")), F.replace(confirm, F.lit("%s"), sentence_case(F.lower("correct_word")))).otherwise(F.replace(confirm, F.lit("%s"), F.lower("correct_word")))
    made = good.withColumn("answer", said).select("n", F.lit("typo").alias("input_class"), "question", "answer", "correct_word", "mangled_word")
    return made.dropDuplicates(["question"]).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("n").cast("string"))), "question").limit(count).drop("n")


def era(spark: SparkSession, count: int, pools: dict[str, tuple[list[str], list[str]]], seed: int = 1930, attempts: int = 60) -> DataFrame:
    """``count`` rows (questions, answers) by kind of era question, distinct by both; ``pools`` hold the questions and answers of each kind."""
    n = F.col("n")
    rows = spark.range(count * attempts).select(F.col("id").alias("n")).withColumn("input_class", weighted_choice(_u(n, "kind", seed), {k: w for k, w in ERA_KINDS.items() if k in pools}))
    q, a = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (qs, as_) in pools.items():
        own = F.col("input_class") == k
        q = F.when(own, F.element_at(F.array(*map(F.lit, qs)), _upto(_u(n, "q", seed), 1, len(qs)))).otherwise(q)
        a = F.when(own, F.element_at(F.array(*map(F.lit, as_)), _upto(_u(n, "a", seed), 1, len(as_)))).otherwise(a)
    return _finish(rows.withColumn("question", q).withColumn("answer", a), "era", count, "question", "answer")


def clauses(texts: DataFrame, text: str, patterns: dict[str, str], blocked: list[str], least: int = 2) -> DataFrame:
    """(kind, clause, n): clauses that stand alone, found by pattern, in lower case and plain ASCII, often enough and not blocked."""
    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)), lambda c: F.struct(F.lit(kind).alias("kind"), F.trim(F.lower(F.regexp_replace(c, r"(?U)\s+", " "))).alias("clause")))

    found = [of(k, p) for k, p in patterns.items()]
    rows = texts.select(F.explode(F.flatten(F.array(*found))).alias("c")).select("c.kind", "c.clause")
    own = rows.where(~F.col("clause").isin(blocked) & S.has(F.col("clause"), r"^\p{ASCII}+$"))
    return own.groupBy("kind", "clause").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def build_all(*routes: DataFrame) -> DataFrame:
    """All routes in one table; columns a route lacks are null."""
    out = routes[0]
    for r in routes[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def scoring_input(rows: DataFrame) -> DataFrame:
    """(id, text): one row for each question, or for each user turn of a conversation as ``doc#turn``."""
    single = rows.where(F.col("conversations").isNull() & F.col("question").isNotNull()).select(F.col("doc_index").alias("id"), F.col("question").alias("text"))
    turns = rows.where(F.col("conversations").isNotNull()).select("doc_index", F.posexplode("conversations").alias("k", "t")).where(F.col("t.role") == "user")
    return single.unionByName(turns.select(F.concat_ws("#", "doc_index", F.col("k").cast("string")).alias("id"), F.col("t.content").alias("text")))


def variants(rows: DataFrame) -> DataFrame:
    """(id, type, variant, text): a row for each non-empty variant of a matched question."""
    names = {"vintage": "q_vintage", "modern": "q_modern", "authentic": "q_authentic"}
    cells = F.array(*[F.struct(F.lit(k).alias("variant"), F.col(c).alias("text")) for k, c in names.items()])
    return rows.select("id", "type", F.explode(cells).alias("v")).select("id", "type", "v.variant", "v.text").where(F.coalesce(F.trim("text"), F.lit("")) != "")
