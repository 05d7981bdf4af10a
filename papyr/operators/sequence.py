"""Sequence operators: chains, turns, windows of pairs, greedy batches, ranked cuts.

Order is always an explicit ordinal column, never the order of rows. One dataset may hold any part of all rows, so no
window runs over a whole one: rows are cut into ranges of (dataset, ordinal), each range is worked on by itself, and
what one range hands to the next (counts, a last row, an open batch) is a small table of a row per dataset and range.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyr.session import materialise


def ranged(rows: DataFrame, group: str, order: str, label: str) -> DataFrame:
    """``rows`` with ``_range``: the number of the range of (group, order) a row lies in. Written once, so that all readers see the same ranges."""
    return materialise(rows.repartitionByRange(F.col(group), F.col(order)).withColumn("_range", F.spark_partition_id()), label)


def _within(group: str, order: str) -> Window:
    return Window.partitionBy("_range", group).orderBy(order)


def _carried(rows: DataFrame, group: str, parts: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``parts`` (group, _range, ...) hands to each range; a null group is a group."""
    own = parts.withColumnsRenamed({group: "_g", "_range": "_r"})
    return rows.join(own, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))).drop("_g", "_r", "_range")


def islands(rows: DataFrame, starts: Column, name: str, group: str, order: str) -> DataFrame:
    """``rows`` with ``name``, the number of the island a row belongs to, from 0: one begins wherever ``starts`` is true, and at a group's first row."""
    r = ranged(rows.withColumn("_b", F.when(starts, 1).otherwise(0)), group, order, "islands")
    per = r.groupBy(group, "_range").agg(F.sum("_b").alias("_n"), F.min_by("_b", order).alias("_first"))
    before = Window.partitionBy(group).orderBy("_range")  # a row per range
    carry = per.select(group, "_range", (F.sum("_n").over(before) - F.col("_n") - F.first("_first").over(before)).alias("_carry"))
    local = r.withColumn("_run", F.sum("_b").over(_within(group, order).rowsBetween(Window.unboundedPreceding, 0)))
    # a first row that starts nothing begins an island all the same
    return _carried(local, group, carry).withColumn(name, F.col("_run") + F.col("_carry")).drop("_b", "_run", "_carry")


def chains(pairs: DataFrame, depends: str = "depends", dataset: str = "dataset", i: str = "i") -> DataFrame:
    """``pairs`` with ``chain``: a pair continues the chain before it if it depends on it. A null flag depends on nothing; the first pair always begins one."""
    return islands(pairs, ~F.coalesce(F.col(depends), F.lit(False)), "chain", dataset, i)


def conversations(chained: DataFrame, dataset: str = "dataset", i: str = "i") -> DataFrame:
    """(dataset, chain, i, conversations, chained) of pairs with ``chain``: the turns of a chain in order; i is its first pair's."""
    pair = F.struct(F.col(i).alias("i"), F.array(F.struct(F.lit("user").alias("role"), F.col("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content"))).alias("turns"))
    got = chained.groupBy(dataset, "chain").agg(F.array_sort(F.collect_list(pair)).alias("_p"))
    return got.select(dataset, "chain", F.col("_p")[0]["i"].alias("i"), F.flatten(F.transform("_p", lambda p: p["turns"])).alias("conversations"), (F.size("_p") > 1).alias("chained"))


def attach(rows: DataFrame, status: str = "status", dataset: str = "dataset", i: str = "i") -> DataFrame:
    """``rows`` with ``output``: bare rows after the first join the row before them, however many follow one another; null status stands alone."""
    return islands(rows, F.coalesce(F.col(status), F.lit("clear")) != "bare", "output", dataset, i)


def merge_attached(attached: DataFrame, turns: str = "conversations", dataset: str = "dataset", i: str = "i") -> DataFrame:
    """(dataset, output, i, conversations, chained, enriched) of rows with ``output``: the turns of all its rows in order; chained if any row was or several joined, enriched if any was. Nulls are false."""
    flag = lambda c: F.max(F.coalesce(F.col(c), F.lit(False)))
    own = attached.groupBy(dataset, "output").agg(F.array_sort(F.collect_list(F.struct(F.col(i).alias("i"), F.col(turns).alias("t")))).alias("_p"), flag("chained").alias("_c"), flag("enriched").alias("_e"))
    empty = F.array().cast(attached.schema[turns].dataType)
    return own.select(dataset, "output", F.col("_p")[0]["i"].alias("i"), F.flatten(F.transform("_p", lambda p: F.coalesce(p["t"], empty))).alias("conversations"), (F.col("_c") | (F.size("_p") > 1)).alias("chained"), F.col("_e").alias("enriched"))


def pair_windows(pairs: DataFrame, size: int = 50, dataset: str = "dataset", i: str = "i") -> DataFrame:
    """``pairs`` with window ``w``, place ``pos`` in it, and the question and answer just before the window (null for the first)."""
    r = ranged(pairs, dataset, i, "windows")
    pair = F.struct("q", "a")
    per = r.groupBy(dataset, "_range").agg(F.count(F.lit(1)).alias("_n"), F.max_by(pair, i).alias("_last"))
    before = Window.partitionBy(dataset).orderBy("_range")  # a row per range
    carry = per.select(dataset, "_range", (F.sum("_n").over(before) - F.col("_n")).alias("_skip"), F.lag("_last").over(before).alias("_prev"))
    local = r.withColumns({"_k": F.row_number().over(_within(dataset, i)), "_lag": F.lag(pair).over(_within(dataset, i))})
    out = _carried(local, dataset, carry).withColumn("_at", F.col("_skip") + F.col("_k") - 1).withColumn("_before", F.when(F.col("_k") == 1, F.col("_prev")).otherwise(F.col("_lag")))
    out = out.withColumns({"w": F.floor(F.col("_at") / size).cast("int"), "pos": (F.col("_at") % size).cast("int")})
    context = F.max(F.when(F.col("pos") == 0, F.col("_before"))).over(Window.partitionBy(dataset, "w"))  # of ``size`` rows
    return out.withColumn("context", context).drop("_at", "_before", "_k", "_lag", "_skip", "_prev")


def alternating_prefix(roles: Column) -> Column:
    """How many turns from the first alternate user, assistant, user, ... without a break, cut to an even number."""
    bad = F.filter(F.transform(roles, lambda r, k: F.when(r.eqNullSafe(F.when(k % 2 == 0, "user").otherwise("assistant")), F.lit(None)).otherwise(k)), lambda k: k.isNotNull())
    n = F.coalesce(F.get(bad, F.lit(0)), F.size(roles))
    return n - n % 2


def opening_stretch(turns: Column, clean: Column, most: int = 12, least: int = 4) -> Column:
    """The first turns up to the first that isn't clean (a parallel array of booleans), alternating, at most ``most``, even in number; null below ``least``."""
    bad = F.filter(F.transform(clean, lambda c, k: F.when(F.coalesce(c, F.lit(False)), F.lit(None)).otherwise(k)), lambda k: k.isNotNull())
    n = F.least(F.coalesce(F.get(bad, F.lit(0)), F.size(clean)), alternating_prefix(F.transform(turns, lambda t: t["role"])), F.lit(most))
    n = n - n % 2
    return F.when(n >= least, F.slice(turns, F.lit(1), n))


def dialogue(lines: Column, names: str | None = None, most: int = 12, least: int = 4) -> Column:
    """Lines (struct with ``text``) by turns as a conversation (role, content): the cleaned lines up to the first that isn't clean, an even number, at most ``most``.

    Null below ``least``, and where the first is plainly a reply.
    """
    from papyr.functions import signals as S

    role = lambda k: F.when(k % 2 == 0, "user").otherwise("assistant")
    turns = F.transform(F.slice(lines, F.lit(1), F.lit(most)), lambda x, k: F.struct(role(k).alias("role"), S.clean_turn(x["text"], role(k), names).alias("content")))
    reply = S.has(F.get(turns, F.lit(0))["content"], S.REPLY_OPENING)
    return F.when(~F.coalesce(reply, F.lit(False)), opening_stretch(turns, F.transform(turns, lambda t: t["content"].isNotNull()), most, least))


def exchanges_kept(turns: Column, verbatim: Column, target: Column, least: int = 4) -> Column:
    """The longest alternating beginning whose answers are verbatim, of at most twice ``target`` turns and an even number; null below ``least``."""
    return opening_stretch(turns, F.transform(turns, lambda t, k: (t["role"] == "user") | F.coalesce(F.get(verbatim, k), F.lit(False))), 1_000_000, least) if target is None else F.slice(
        opening_stretch(turns, F.transform(turns, lambda t, k: (t["role"] == "user") | F.coalesce(F.get(verbatim, k), F.lit(False))), 1_000_000, least), F.lit(1), 2 * target
    )


def with_history(turns: Column) -> Column:
    """(question, answer) of each exchange, the question with all turns before it."""
    n = F.floor(F.size(turns) / 2).cast("int")

    def line(t: Column) -> Column:
        return F.concat(F.when(t["role"] == "user", "User: ").otherwise("Assistant: "), F.coalesce(t["content"], F.lit("")))

    def one(k: Column) -> Column:
        q, a = F.get(turns, 2 * k), F.get(turns, 2 * k + 1)
        past = F.array_join(F.transform(F.slice(turns, F.lit(1), 2 * k), line), "\n")
        return F.struct(F.when(k > 0, F.concat(past, F.lit("\n"), line(q))).otherwise(F.coalesce(q["content"], F.lit(""))).alias("question"), a["content"].alias("answer"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<struct<question:string,answer:string>>"))


def as_text(turns: Column) -> Column:
    """A conversation as lines of ROLE: content."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.upper(F.coalesce(t["role"], F.lit(""))), F.lit(": "), F.coalesce(t["content"], F.lit("")))), "\n")


def _blocks(t: pa.Table) -> Iterator[tuple[object, list, list[int]]]:
    """(group, order values, sizes) of each group in a range's rows (g, o, s), in order."""
    rows = sorted(zip(t.column("g").to_pylist(), t.column("o").to_pylist(), t.column("s").to_pylist(), strict=True), key=lambda r: ((r[0] is not None, r[0]), (r[1] is not None, r[1])))
    for g, own in groupby(rows, key=lambda r: r[0]):
        block = list(own)
        yield g, [r[1] for r in block], [r[2] for r in block]


def _next_starts(run: list[int], budget: int, cap: int) -> list[int]:
    """For a batch that begins at each place, where the one after it begins; ``run`` are the running sums from 0."""
    n = len(run) - 1
    return [max(min(bisect_right(run, run[i] + budget) - 1, i + cap, n), i + 1) for i in range(n)]


def greedy_batches(items: DataFrame, size: str, budget: int, group: str, order: str, most: int | None = None) -> DataFrame:
    """``items`` (group, order, size, ...) with ``batch`` from 0: in order, a batch closes before the item that would pass its budget or its ``most`` items.

    An item beyond the budget has a batch of its own. Null sizes count 0 (none may be negative); ``order`` should be a key.
    Where a batch that begins at an item ends depends on nothing before it. So each range tells, for each place of its
    first batch at which one may begin, what it hands on; a pass over these few rows gives every range the batch
    that is open where it begins; then the ranges number their items side by side.
    """
    cap = most if most is not None else 2**31 - 1
    kinds = {"g": items.schema[group].dataType.simpleString(), "o": items.schema[order].dataType.simpleString()}
    keys = ranged(items.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("s")), "g", "o", "batches")

    def tell(t: pa.Table) -> pa.Table:
        out = []
        r = t.column("_range")[0].as_py()
        for g, _, sizes in _blocks(t):
            run = list(accumulate(sizes, initial=0))
            n = len(sizes)
            nxt = _next_starts(run, budget, cap)
            last, closed = list(range(n)), [0] * n  # of a batch begun here: the last that begins in the range, and how many close
            for i in range(n - 1, -1, -1):
                if nxt[i] < n:
                    last[i], closed[i] = last[nxt[i]], closed[nxt[i]] + 1
            out += [(g, r, e, run[e], sizes[e], run[n] - run[last[e]], n - last[e], closed[e]) for e in range(min(nxt[0], n - 1) + 1)]
            out.append((g, r, n, run[n], 0, run[n], n, -1))  # none begins here
        return _table(out, g=t.schema.field("g").type, _range=pa.int32(), e=pa.int64(), before=pa.int64(), s=pa.int64(), sum=pa.int64(), n=pa.int64(), closed=pa.int64())

    told = keys.groupBy("_range").applyInArrow(lambda t: tell(t), f"g {kinds['g']}, _range int, e long, before long, s long, sum long, n long, closed long")

    def carry(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*[t.column(c).to_pylist() for c in ("_range", "e", "before", "s", "sum", "n", "closed")], strict=True))
        total, n, batch, out = 0, 0, 0, []
        for r, own in groupby(rows, key=lambda x: x[0]):
            out.append((t.column("g")[0].as_py(), r, total, n, batch))
            for _, e, before, size_, last_sum, last_n, closed in own:
                if closed < 0:  # the open batch takes all of the range
                    total, n = total + before, n + e
                elif n == 0 or total + before + size_ > budget or n + e >= cap:
                    total, n, batch = last_sum, last_n, batch + closed + (n > 0)
                    break
        return _table(out, g=t.schema.field("g").type, _range=pa.int32(), sum=pa.int64(), n=pa.int64(), batch=pa.int64())

    state = told.groupBy("g").applyInArrow(lambda t: carry(t), f"g {kinds['g']}, _range int, sum long, n long, batch long")

    def number(t: pa.Table) -> pa.Table:
        start = {g: (a, b, c) for g, a, b, c in zip(*[t.column(x).to_pylist() for x in ("g", "sum", "n", "batch")], strict=True)}
        out = []
        for g, orders, sizes in _blocks(t):
            total, n, batch = start[g]
            for o, s in zip(orders, sizes, strict=True):
                if n and (total + s > budget or n >= cap):
                    total, n, batch = 0, 0, batch + 1
                total, n = total + s, n + 1
                out.append((g, o, batch))
        return _table(out, g=t.schema.field("g").type, o=t.schema.field("o").type, batch=pa.int32())

    own = state.withColumnsRenamed({"g": "_g", "_range": "_r"})
    ready = keys.join(own, F.col("g").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))).drop("_g", "_r")
    numbered = ready.groupBy("_range").applyInArrow(lambda t: number(t), f"g {kinds['g']}, o {kinds['o']}, batch int").withColumnsRenamed({"g": "_batch_group", "o": "_batch_order"})
    return items.join(numbered, F.col(group).eqNullSafe(F.col("_batch_group")) & F.col(order).eqNullSafe(F.col("_batch_order"))).drop("_batch_group", "_batch_order")


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def primary_class(classes: Column, order: list[str]) -> Column:
    """The first class of a fixed order that is present, else ``drop``."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, order)), lambda c: F.array_contains(F.coalesce(classes, F.array().cast("array<string>")), c)), F.lit(0)), F.lit("drop"))


def ranked_cut(rows: DataFrame, score: str, fraction: float, *order: str) -> DataFrame:
    """``rows`` with ``dropped``: the lowest ``floor(n * fraction)`` scored rows, ties in ``order``. Null scores are never dropped.

    The row at the cut comes from :func:`row_at_rank`; all else is a filter.
    """
    scored = rows.where(F.col(score).isNotNull())
    k = int(scored.count() * fraction)
    if k == 0:
        return rows.withColumn("dropped", F.lit(False))
    edge = row_at_rank(scored, [F.col(score).asc(), *[F.col(c).asc() for c in order]], [score, *order], k)
    last = F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip((score, *order), edge, strict=True)])
    return rows.withColumn("dropped", F.coalesce(F.struct(score, *order) <= last, F.lit(False)) & F.col(score).isNotNull())


def row_at_rank(rows: DataFrame, by: list[Column], columns: list[str], k: int) -> tuple:
    """The values of ``columns`` in the k-th row (from 1) in the order ``by``.

    The rows' keys are cut into ranges, each sorted alone; the ranges' counts tell in which one the row lies,
    and only that one is looked into. No task or driver sees all rows.
    """
    keys = materialise(rows.select(*columns).repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "ranks")
    left = k
    for r in sorted(keys.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_range"]):
        if left <= r["n"]:
            got = keys.where(F.col("_range") == r["_range"]).select(*columns).orderBy(*by).offset(left - 1).limit(1).collect()[0]
            return tuple(got[c] for c in columns)
        left -= r["n"]
    raise ValueError(f"there is no row of rank {k}")


def top_fraction_drop(rows: DataFrame, score: str, fraction: float, order: str) -> DataFrame:
    """``rows`` with ``dropped``: of the rows at or above the score of rank ``int(n * fraction)`` the first so many in ``order``; null scores stay."""
    scored = rows.where(F.col(score).isNotNull())
    k = int(scored.count() * fraction)
    if k == 0:
        return rows.withColumn("dropped", F.lit(False))
    (at,) = row_at_rank(scored, [F.col(score).desc()], [score], k)
    (last,) = row_at_rank(scored.where(F.col(score) >= at), [F.col(order).asc()], [order], k)
    return rows.withColumn("dropped", F.coalesce((F.col(score) >= at) & (F.col(order) <= F.lit(last)), F.lit(False)))


def two_party_runs(lines: DataFrame, least: int = 4) -> DataFrame:
    """(book, run, turns) of dialogue lines (book, pos, speaker, text).

    In order of pos, a run ends where a speaker speaks twice, and where a third one comes in, who begins a new
    run together with the line before. Runs below ``least`` lines are dropped. One book at a time, as runs share lines.
    """
    import pandas as pd

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("pos")[["speaker", "text"]].itertuples(index=False, name=None))
        runs, cur = [], []
        for speaker, text in rows:
            names = {s for s, _ in cur}
            if cur and cur[-1][0] == speaker:
                runs.append(cur)
                cur = []
            elif len(names | {speaker}) > 2:
                runs.append(cur)
                cur = [cur[-1]]
            cur.append((speaker, text))
        runs.append(cur)
        kept = [r for r in runs if len(r) >= least]
        return pd.DataFrame({"book": [pdf["book"].iloc[0]] * len(kept), "run": range(len(kept)), "turns": [[{"speaker": s, "text": t} for s, t in r] for r in kept]})

    kind = lines.schema["book"].dataType.simpleString()
    return lines.groupBy("book").applyInPandas(one, f"book {kind}, run int, turns array<struct<speaker:string,text:string>>")
