"""Evaluation texts leaking into training text: size-partitioned min-hash containment search with exact verification.

Sets are word shingles of SHINGLE words. A passage of run words is the smallest set that counts, so every item is queried
as its windows of that size, and every document is partitioned into the windows of the same size class: within the class
containment 1 is Jaccard similarity 1, and a single min-hash agrees with certainty. A document's signature is thus the
set of its window minima (about 2 / (run - SHINGLE + 2) of its positions). Where a minimum meets one of an item's, the
words around both positions are compared, and the pair counts if at least run consecutive words are the same.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.session import cut_lineage, if_small, spread

RUN = 12
SHINGLE = 5
BROADCAST_ROWS = 20_000  # items, at most, that are sent to every task; beyond, signatures are joined
BROADCAST_CHARS = 4_000_000  # and characters of item text
WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
PART_CHARS = 1 << 20  # a longer document is searched in parts of that many characters, which overlap


def word_codes(words: list[str], cache: dict[str, int]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        c = cache.get(w)
        if c is None:
            if len(cache) > 500_000:
                cache.clear()
            b = w.encode()
            c = cache[w] = (zlib.crc32(b) << 32) | zlib.adler32(b + b"#")
        out[i] = c
    return out


def window_minima(words: list[str], run: int, shingle: int, cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, min-hashes): the distinct minima of all windows of run words; empty if there are fewer words."""
    n = len(words)
    if n < run:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    c = word_codes(words, cache)
    h = np.zeros(n - shingle + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(shingle):
            h = (h ^ c[k : n - shingle + 1 + k]) * MIX
            h ^= h >> np.uint64(29)
        h *= MIX
        h ^= h >> np.uint64(32)
    width = run - shingle + 1
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return at, h[at]


def shared_run(a: list[str], i: int, b: list[str], j: int, run: int) -> bool:
    """Whether the words around a[i] and b[j] are the same over at least run places."""
    left = 0
    while left < run and i > left and j > left and a[i - left - 1] == b[j - left - 1]:
        left += 1
    k = 0
    while k + left < run and i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
        k += 1
    return left + k >= run


def item_table(rows: list[tuple[int, str]], run: int, shingle: int) -> tuple[dict[int, list[str]], dict[int, list[tuple[int, int]]]]:
    words: dict[int, list[str]] = {}
    sigs: dict[int, list[tuple[int, int]]] = {}
    cache: dict[str, int] = {}
    for item, text in rows:
        w = words[item] = WORD.findall(text.lower())
        at, h = window_minima(w, run, shingle, cache)
        for p, x in zip(at.tolist(), h.tolist(), strict=True):
            sigs.setdefault(x, []).append((item, p))
    return words, sigs


def parts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents as parts of at most PART_CHARS characters; neighbours overlap by half a part, so that no run of up to that length is broken."""
    n = F.char_length(text)
    step = PART_CHARS // 2
    starts = F.when(n <= PART_CHARS, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.greatest(n - step - 1, F.lit(0)), F.lit(step)))
    return docs.where(F.col(text).isNotNull()).select(key, text, F.posexplode(starts).alias("part", "_s")).select(key, "part", F.when(F.char_length(text) <= PART_CHARS, F.col(text)).otherwise(F.col(text).substr(F.col("_s") + 1, F.lit(PART_CHARS))).alias("t"))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "item_text", run: int = RUN, shingle: int = SHINGLE) -> DataFrame:
    """(key, item): every pair with at least run consecutive words in common, each once.

    Null and empty texts, and texts of fewer than run words, match nothing. Repeated documents each come out. Items that
    are few and short (both checked) go to every task, and the documents are neither shuffled nor sorted; otherwise
    signatures are joined: of the documents only the signatures that some item has, then of each document that has any
    the words around these, which are held against the words around the item's. No text is paired with another.
    """
    spark = docs.sparkSession
    it = items.where(F.col(item_text).isNotNull()).select(F.col(item).alias("item"), F.col(item_text).alias("item_text"))
    size = it.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length("item_text")), F.lit(0)).alias("c")).first()
    d = spread(parts(docs, key, text))
    kind = dict(items.dtypes)[item]
    key_kind = dict(docs.dtypes)[key]
    if size["n"] <= BROADCAST_ROWS and size["c"] <= BROADCAST_CHARS:
        table = spark.sparkContext.broadcast(item_table([(r["item"], r["item_text"]) for r in it.collect()], run, shingle))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            words, sigs = table.value
            cache: dict[str, int] = {}
            for b in batches:
                out = []
                for doc, t in zip(b[key].tolist(), b["t"].tolist(), strict=True):
                    w = WORD.findall(t.lower())
                    at, h = window_minima(w, run, shingle, cache)
                    hit: set[int] = set()
                    for p, x in zip(at.tolist(), h.tolist(), strict=True):
                        for i, q in sigs.get(x, ()):
                            if i not in hit and shared_run(w, p, words[i], q, run):
                                hit.add(i)
                    out += [(doc, i) for i in hit]
                yield pd.DataFrame(out, columns=[key, item])

        found = d.mapInPandas(search, f"{key} {key_kind}, {item} {kind}")
    else:

        def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cache: dict[str, int] = {}
            for b in batches:
                out = []
                for k, part, t in zip(b["k"].tolist(), b["part"].tolist(), b["t"].tolist(), strict=True):
                    _, h = window_minima(WORD.findall(t.lower()), run, shingle, cache)
                    out += [(k, part, x) for x in set(h.astype(np.int64).tolist())]
                yield pd.DataFrame(out, columns=["k", "part", "x"])

        def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cache: dict[str, int] = {}
            for b in batches:
                out = []
                for k, t, xs in zip(b["k"].tolist(), b["t"].tolist(), b["xs"].tolist(), strict=True):
                    w = WORD.findall(t.lower())
                    at, h = window_minima(w, run, shingle, cache)
                    wanted = None if xs is None else set(xs)
                    for p, x in zip(at.tolist(), h.astype(np.int64).tolist(), strict=True):
                        if wanted is None or x in wanted:
                            a = max(0, p - run + 1)
                            out.append((k, x, p - a, " ".join(w[a : p + run])))
                yield pd.DataFrame(out, columns=["k", "x", "p", "w"])

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = zip(*(b[c].tolist() for c in ("doc", "item", "dp", "dw", "ip", "iw")), strict=True)
                out = {(d_, i) for d_, i, dp, dw, ip, iw in rows if shared_run(dw.split(" "), dp, iw.split(" "), ip, run)}
                yield pd.DataFrame(list(out), columns=[key, item])

        every = d.select(F.col(key).alias("k"), "part", "t")
        qs = it.select(F.col("item").alias("k"), F.col("item_text").alias("t"), F.lit(None).cast("array<bigint>").alias("xs")).mapInPandas(around, f"k {kind}, x bigint, p int, w string")
        qs = cut_lineage(qs.select(F.col("k").alias("item"), "x", F.col("p").alias("ip"), F.col("w").alias("iw")))
        met = every.mapInPandas(sign, f"k {key_kind}, part int, x bigint").join(if_small(qs.select("x").distinct()), "x", "left_semi")
        met = met.groupBy("k", "part").agg(F.collect_set("x").alias("xs"))  # of one part of a document, so bounded
        ds = every.join(met, ["k", "part"]).select("k", "t", "xs").mapInPandas(around, f"k {key_kind}, x bigint, p int, w string")
        both = ds.select(F.col("k").alias("doc"), "x", F.col("p").alias("dp"), F.col("w").alias("dw")).join(qs, "x")
        found = both.select("doc", "item", "dp", "dw", "ip", "iw").mapInPandas(compare, f"{key} {key_kind}, {item} {kind}")
    return found.distinct()


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per test item: the number of corpus documents that hold a passage of it."""
    n = leaks(docs, items).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    return items.select("item_id", "task").join(n, "item_id", "left").select("item_id", "task", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
