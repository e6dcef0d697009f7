"""Text cut off by field limits: length spikes per source and column, and a fitted model of ends for what was broken off below a limit.

Method: per source and column the histograms of lengths in characters and in bytes are tested for a spike at the
maximum; values of a spike length that lack a terminal mark were cut by the limit. That can't find values broken off in
transfer, at any length, so a second detector judges the ends of all values: a linear model over how an end looks, what
recurs at ends over the whole column, and hashed n-grams of the last words, fitted on the column's own texts against the
same texts cut at random places. Which unpunctuated ends are closing phrases is counted over the whole column: a phrase
that ends a fixed share of its values and starts no longer sentence.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm import linear, tails
from tesserae.llm.tails import MARKUP, MISSING, TAIL_CHARS, look
from tesserae.session import cut_lineage, if_small, thinned

CLOSER_SHARE = 0.001  # share of a column's values that must end in a phrase for it to be a closing phrase
SPIKE_WINDOW = 40  # lengths below the maximum that the maximum is held against
SPIKE_LEAST = 5  # values at the maximum, at least
SPIKE_SIGMAS = 6.0
TRAIN_VALUES = 3000  # rows, at most, whose values the model of ends is fitted on
LEAST_ENDS = 2000  # cut ends that it is fitted on, at least; of fewer texts each is cut more than once
SLIM = "field string, text_id bigint, n_chars int, n_bytes int, echo boolean, terminal boolean, state string, tpl string, before string, given boolean, whole boolean, grams array<int>"


def void(c: str) -> Column:
    """Null, or nothing but blanks, punctuation, markup, section markers or a word for a missing value."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.col(c), MARKUP, " "), r"[^\p{L}\p{N}]+", " "))
    plain = ~(F.contains(c, F.lit("<")) | F.contains(c, F.lit("[[")) | F.contains(c, F.lit("```")))
    said = plain & F.col(c).rlike(r"[\p{L}\p{N}](?:[^\p{L}\p{N}]*[\p{L}\p{N}]){14}")  # no word for a missing value is as long
    return F.col(c).isNull() | F.when(said, False).otherwise((bare == "") | bare.rlike(f"^{MISSING}$"))


WORD = re.compile(r"[^\W_]+")
LABEL = re.compile(r"^[\w ]{1,25}: ")
LAST = re.compile(r"[\s…�.?!\"”“]+$")


def echoes(text: str, prompt: str | None) -> bool:
    """Whether the text only repeats or reorders its prompt; such a text ends where the prompt was broken, not cut. One
    that begins as the prompt does, but isn't the whole of it, is no echo."""
    if not prompt or len(text) < 0.75 * len(prompt):
        return False
    w = WORD.findall(text.lower())
    if len(set(w).difference(WORD.findall(prompt.lower()))) > 0.08 * len(w):
        return False
    a, b = LAST.sub("", LABEL.sub("", text.strip())).lower(), LAST.sub("", prompt.strip()).lower()
    return a == b or not a.startswith(b[:25])


def end_of(tail: str, intact: str | None) -> tuple[bool, str, str, str, bool, bool, list[int]]:
    """(has a terminal mark, state, last segment, the one before, ends with an answer, ends with the intact answer, n-grams)."""
    state, tpl, before = look(tail, intact)
    t, whole = tail.rstrip(), (intact or "").strip()
    ends_whole = bool(whole) and (t.endswith(whole) or t.rstrip(".。 ").endswith(whole.rstrip(". ")))
    given = ends_whole or tails.states_answer(tail)
    return bool(tails.END_RE.search(t)), state, tpl, before, given, ends_whole, tails.end_grams(tail, given)


def values(df: DataFrame, columns: Sequence[str], keep: Sequence[str], source: str, prompt: str | None) -> DataFrame:
    """One row per non-empty value: its lengths, its end, and, if it has no terminal mark, the whole to hold against its prompt."""
    asked = F.col(prompt) if prompt else F.lit(None).cast("string")

    def part(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("field"),
            F.xxhash64(c).alias("text_id"),
            F.char_length(c).alias("n_chars"),
            F.octet_length(c).alias("n_bytes"),
            F.expr(f"right(`{c}`, {TAIL_CHARS})").alias("tail"),
            void(c).alias("blank"),
            (F.when(~F.expr(f"right(rtrim(' \t\r\n', `{c}`), 1)").isin(list(tails.TERMINAL)), F.col(c)) if prompt else F.lit(None).cast("string")).alias("full"),
        )

    long = df.select(*keep, F.coalesce(F.col(source), F.lit("")).alias("source"), asked.alias("asked"), F.explode(F.array(*map(part, columns))).alias("v"))
    return long.select(*keep, "source", "asked", "v.*").where(~F.col("blank")).drop("blank")


def ends(v: DataFrame, key: str) -> DataFrame:
    """The slim rows with their ends read; v: values() with the column intact."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, g, full, asked in zip(*(b[c].tolist() for c in ("tail", "intact", "full", "asked")), strict=True):
                e = end_of(t, g)
                rows.append((e[1] == "open" and full is not None and echoes(full, asked), *e))
            got = pd.DataFrame(rows, columns=["echo", "terminal", "state", "tpl", "before", "given", "whole", "grams"], index=b.index)
            yield pd.concat([b[[key, "source", "field", "text_id", "n_chars", "n_bytes"]], got], axis=1)[[key, "source", *(x.split()[0] for x in SLIM.split(", "))]]

    return v.mapInPandas(read, f"{key} {dict(v.dtypes)[key]}, source string, {SLIM}")


def spikes(v: DataFrame, unit: str) -> DataFrame:
    """(source, field, limit): maxima that hold far more distinct values than the lengths just below them. Only lengths
    next to a maximum leave their tasks."""
    top = v.groupBy("source", "field").agg(F.max(unit).alias("limit"))
    near = v.join(if_small(top), ["source", "field"]).where(F.col(unit) >= F.col("limit") - SPIKE_WINDOW)
    near = near.select("source", "field", "limit", (F.col(unit) == F.col("limit")).alias("_at"), "text_id").distinct()
    got = near.groupBy("source", "field", "limit").agg(F.sum(F.col("_at").cast("int")).alias("at"), F.sum((~F.col("_at")).cast("int")).alias("below"))
    rate = F.col("below") / F.lit(float(SPIKE_WINDOW))
    return got.where((F.col("at") >= SPIKE_LEAST) & (F.col("at") > rate + SPIKE_SIGMAS * F.sqrt(rate + 1))).select("source", "field", "limit")


def recurring(rows: DataFrame, phrase: str, least: Column) -> list[tuple[str, str, int]]:
    """(field, phrase, n) of the phrases of at least `least` distinct values: at most 1/share of them, whatever the data.

    Rows are counted first, with a combine in every task, and only what they allow is counted by distinct values.
    """
    likely = rows.groupBy("field", "total", F.col(phrase).alias("s")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    likely = if_small(likely.select("field", "s", F.xxhash64("s").alias("sid")))
    n = rows.select("field", "total", "text_id", F.xxhash64(phrase).alias("sid")).join(likely, ["field", "sid"]).groupBy("field", "total", "s").agg(F.count_distinct("text_id").alias("n"))
    return [(r["field"], r["s"], r["n"]) for r in n.where(F.col("n") >= least).collect()]


def phrases(v: DataFrame) -> tuple[set[tuple[str, str]], set[tuple[str, str]]]:
    """(closing phrases, sentences that end in a run of dots of their own), each as (field, phrase).

    A closing phrase is an unpunctuated last segment that recurs as the end of distinct values and starts no longer
    sentence of the column; a dotted sentence also occurs inside the texts.
    """
    total = v.groupBy("field").agg(F.count_distinct("text_id").alias("total"))
    v = v.join(F.broadcast(total), "field")  # one row per column
    share = F.col("total") * CLOSER_SHARE
    open_ = recurring(v.where((F.col("state") == "open") & (F.char_length("tpl") >= 4)), "tpl", F.greatest(F.lit(2.0), share / 20))
    starts = recurring(v.where(F.col("before") != ""), "before", F.greatest(F.lit(3.0), share))
    inner = v.where(F.col("before").rlike(r"(\.\.\.|…)$")).withColumn("s2", F.concat_ws(" ", F.split("before", " ")[0], F.element_at(F.split("before", " "), -1)))
    dots = recurring(inner, "s2", F.greatest(F.lit(2.0), share / 4))
    least = {r["field"]: max(3.0, r["total"] * CLOSER_SHARE) for r in total.collect()}
    longer: dict[str, list[str]] = {}
    for field, s, _ in [*open_, *starts]:
        longer.setdefault(field, []).append(s)
    for one in longer.values():
        one.sort()
    closers = set()
    for field, s, n in open_:
        if n >= least[field]:
            k = np.searchsorted(longer[field], s + "\0")  # what starts with s follows it in order
            if k == len(longer[field]) or not longer[field][k].startswith(s):
                closers.add((field, s))
    return closers, {(f, s) for f, s, _ in dots}


def features(field: str, state: str, tpl: str, given: bool, whole: bool, sets: tuple[set, set]) -> list[float]:
    closers, dotted = sets
    closer, dots = (field, tpl) in closers, state == "mark" and (field, tpl) in dotted
    return [1.0, *(float(state == x) for x in tails.STATES), float(closer), float(dots), float(given), float(whole), float(state == "open" and not closer), float(state == "open" and not closer and not given), float(state == "mark" and not dots)]


def sample_ends(df: DataFrame, columns: Sequence[str], key: str, rows: int) -> list[tuple[str, str, str | None, int, int]]:
    """(field, tail, intact answer, 1 if cut, hash of the whole text) of the values of at most `rows` rows, whole and cut at random places. Cuts
    are made where the rows are; only ends reach the driver."""
    picked = thinned(df, key, rows).orderBy(F.xxhash64(key), key).limit(rows)
    n = max(1, picked.count())
    times = -(-LEAST_ENDS // (n * len(columns)))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                for c in columns:
                    t = r[c]
                    if t is None or len(t) < 12:
                        continue
                    rng = random.Random(t)  # a text that is delivered again is cut at the same places, and counts once
                    for i in range(times):
                        out.append((c, t[-TAIL_CHARS:], r["intact"], 0, zlib.crc32(t.encode()), i))
                        k = next((k for k in (rng.randint(8, len(t) - 2) for _ in range(20)) if t[k - 1].isalnum()), None)
                        if k:
                            out.append((c, (t[max(0, k - TAIL_CHARS) : k] + rng.choice(["", "", "", "", "…", "...", " [truncated]", "�", " "]))[-TAIL_CHARS:], r["intact"], 1, zlib.crc32(t.encode()), i))
            yield pd.DataFrame(out, columns=["field", "tail", "intact", "cut", "text", "i"])

    got = picked.select(key, "intact", *columns).mapInPandas(make, "field string, tail string, intact string, cut int, text bigint, i int")
    return [x[:5] for x in sorted({tuple(r) for r in got.collect()}, key=str)]


class EndModel:
    def __init__(self, sets: tuple[set, set]) -> None:
        self.sets, self.w, self.h, self.least = sets, np.zeros(1), np.zeros(1 << linear.BITS), 0.0

    def inputs(self, rows: Sequence[tuple[str, str, str, bool, bool, Sequence[int]]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """rows: field, state, last segment, given, whole, n-grams."""
        return np.asarray([features(*r[:5], self.sets) for r in rows]), [np.asarray(r[5], np.int64) for r in rows]

    def scores(self, rows: Sequence[tuple]) -> np.ndarray:
        return linear.scores(*self.inputs(rows), self.w, self.h) - self.least

    def fit(self, sample: list[tuple[str, str, str | None, int, int]]) -> EndModel:
        """Fitted twice: whole texts that a fit on the other half of the texts takes for cut more likely than not were cut before, and
        are left out of the second. A fifth is held out for the threshold. Without ends nothing is told."""
        if len(sample) < 10:
            self.w, self.least = np.zeros(len(features("", "", "", False, False, self.sets))), 1e9
            return self
        rows = [(f, e[1], e[2], e[4], e[5], e[6]) for f, t, g, *_ in sample for e in (end_of(t, g),)]
        y = np.asarray([r[3] for r in sample], np.float64)
        x, bags = self.inputs(rows)
        part = lambda m: (x[m], [b for b, k in zip(bags, m, strict=True) if k], y[m])
        text = np.asarray([r[4] for r in sample], np.int64)
        half, test = text % 2 == 0, text // 2 % 5 == 0
        keep = np.ones(len(y), bool)
        for side in (half, ~half) if half.any() and not half.all() else ():
            z = linear.scores(*part(~side)[:2], *linear.fit(*part(side), epochs=6))
            keep[~side] = (z <= 0) | (y[~side] == 1)
        self.w, self.h = linear.fit(*part(keep & ~test))
        z = linear.scores(*part(keep & test)[:2], self.w, self.h)
        self.least = linear.threshold(z[y[keep & test] == 1], z[y[keep & test] == 0])
        return self


def with_answers(df: DataFrame, intact: DataFrame | None, key: str = "sample_id") -> DataFrame:
    from tesserae.llm.pairs import with_intact

    return with_intact(df, intact, key)


def cut_values(df: DataFrame, columns: Sequence[str], key: str = "seq", source: str = "setting", intact: DataFrame | None = None, prompt: str | None = None, sample: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(cut, all): cut has key, source, field and cause of every cut value; all has source and field of every non-empty value.

    intact: sample and final_answer_sql, where the answer that a text should end with is known. A null, blank or
    mark-only value is never cut, nor is one that only repeats its prompt, ends how it may. A value at a spike of its
    source and column without a terminal mark is cut by the limit unless it ends with its intact answer; all others are
    judged by their ends. Repeated rows are judged each, but count once as evidence. An empty table gives no rows.
    """
    keys = [key, sample] if intact is not None else [key]
    v = with_answers(values(df, columns, keys, source, prompt), intact, sample)
    v = cut_lineage(ends(v, key))  # read again for every statistic, with no text in it
    sets = phrases(v)
    train = with_answers(df.select(*keys, *columns), intact, sample)
    model = EndModel(sets).fit(sample_ends(train, columns, key, TRAIN_VALUES))
    carried = df.sparkSession.sparkContext.broadcast((sets, model.w, model.h, model.least))  # bounded phrases, fixed weights

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = EndModel(carried.value[0])
        _, m.w, m.h, m.least = carried.value
        for b in batches:
            if len(b):
                rows = list(zip(*(b[c].tolist() for c in ("field", "state", "tpl", "given", "whole", "grams")), strict=True))
                yield b[[key, "source", "field", "n_chars", "n_bytes", "echo", "terminal", "state", "whole"]].assign(open=m.scores(rows) >= 0)

    j = v.mapInPandas(judge, f"{key} {dict(v.dtypes)[key]}, source string, field string, n_chars int, n_bytes int, echo boolean, terminal boolean, state string, whole boolean, open boolean")
    j = j.join(if_small(spikes(v, "n_chars").withColumnRenamed("limit", "c_limit")), ["source", "field"], "left")
    j = j.join(if_small(spikes(v, "n_bytes").withColumnRenamed("limit", "b_limit")), ["source", "field"], "left")
    at_limit = F.coalesce(F.col("n_chars") == F.col("c_limit"), F.lit(False)) | F.coalesce(F.col("n_bytes") == F.col("b_limit"), F.lit(False))
    by_limit = at_limit & ~F.col("terminal") & ~F.col("whole")
    cut = j.where((by_limit | F.col("open")) & ~F.col("echo"))
    return cut.select(key, "source", "field", F.when(by_limit, "limit").otherwise("transfer").alias("cause")), v.select("source", "field")


def cut_share(df: DataFrame, columns: Sequence[str], key: str = "seq", source: str = "setting", intact: DataFrame | None = None, prompt: str | None = None) -> DataFrame:
    """Per source and column: values, cut values and their share."""
    cut, every = cut_values(df, columns, key, source, intact, prompt)
    n = every.groupBy("source", "field").agg(F.count("*").alias("n_values"))
    c = cut.groupBy("source", "field").agg(F.count("*").alias("n_cut"), F.sum((F.col("cause") == "limit").cast("long")).alias("n_at_limit"))
    return n.join(c, ["source", "field"], "left").select(
        "source", "field", "n_values", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), F.coalesce("n_at_limit", F.lit(0)).alias("n_at_limit"), F.round(F.coalesce("n_cut", F.lit(0)) / F.col("n_values"), 6).alias("cut_share")
    )
