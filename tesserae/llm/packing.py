"""Filling fixed-capacity containers: variable-capacity best-fit over the histogram of item lengths.

Lengths are tokens of a public tokenizer, so at most as many different ones exist as a container has places. The plan
is made on that bounded histogram: the largest length left opens the permitted container of least cost, best fit fills
it, and the pattern is repeated as often as the counts allow. Documents then take their places by their rank within
their length, which is counted in salted buckets, so that neither a hot length nor the driver ever holds documents.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.session import cut_lineage, spread

CAPACITY = 2048
SIZES = (512, 1024, 2048)  # permitted container lengths; the greatest is the capacity
OPEN_COST = 4.0  # tokens of waste that opening a container counts as, so equal waste goes to the larger one
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  # the default of a parameter
#: Fixed value: how the text is split into pieces before they are merged, as that vocabulary's description states it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SALTS = 64


def token_ranks(path: str = TOKENIZER) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def token_counts(docs: DataFrame, key: str, text: str, path: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """(key, n_tokens) of every row; null and empty texts have 0 tokens."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((token_ranks(path), pattern))  # one vocabulary, of fixed size
    kind = dict(docs.dtypes)[key]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks, pat = shared.value
        enc = tiktoken.Encoding("own", pat_str=pat, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["t"].tolist()]
            yield pd.DataFrame({key: b[key], "n_tokens": n})

    return spread(docs.select(key, F.col(text).alias("t"))).mapInPandas(count, f"{key} {kind}, n_tokens int")


def fill(counts: dict[int, int], sizes: list[int], room: int, first: int) -> tuple[list[int], int]:
    """Best fit for one container: the largest length that fits, again and again, the last two chosen together where
    that leaves less; (lengths, space left)."""
    used: dict[int, int] = {first: 1}
    got, left = [first], room - first
    while left > 0:
        i = bisect_right(sizes, left) - 1
        while i >= 0 and counts[sizes[i]] - used.get(sizes[i], 0) <= 0:
            i -= 1
        if i < 0:
            break
        s = sizes[i]
        if s < left:  # a pair that fills the rest better than this one and what follows it
            best, pair = left - s, None
            k = i
            while k >= 0:
                a = sizes[k]
                if counts[a] - used.get(a, 0) > 0:
                    j = bisect_right(sizes, left - a) - 1
                    while j >= 0 and counts[sizes[j]] - used.get(sizes[j], 0) - (sizes[j] == a) <= 0:
                        j -= 1
                    if j >= 0 and left - a - sizes[j] < best:
                        best, pair = left - a - sizes[j], (a, sizes[j])
                        if best == 0:
                            break
                k -= 1
            if pair and best == 0:
                for a in pair:
                    used[a] = used.get(a, 0) + 1
                    got.append(a)
                left = 0
                break
        used[s] = used.get(s, 0) + 1
        got.append(s)
        left -= s
    return got, left


def plan(hist: dict[int, int], permitted: Sequence[int] = SIZES, open_cost: float = OPEN_COST) -> list[tuple[int, list[int], int]]:
    """(capacity, lengths, times): patterns that place every item of the histogram, in the order they were opened."""
    counts = {s: c for s, c in hist.items() if c > 0}
    sizes = sorted(counts)
    permitted = sorted(permitted)
    out: list[tuple[int, list[int], int]] = []
    while sizes:
        first = sizes[-1]
        best = None
        for cap in permitted:
            if cap < first:
                continue
            got, left = fill(counts, sizes, cap, first)
            cost = (left + open_cost) / (cap - left)
            if best is None or cost <= best[0]:
                best = (cost, cap, got, left)
        _, cap, got, left = best
        cap = next(c for c in permitted if c >= cap - left)  # downsized to its contents
        use: dict[int, int] = {}
        for s in got:
            use[s] = use.get(s, 0) + 1
        times = min(counts[s] // k for s, k in use.items())
        out.append((cap, got, times))
        for s, k in use.items():
            counts[s] -= k * times
            if not counts[s]:
                del counts[s]
                sizes.remove(s)
    return out


def pieces(counts: DataFrame, key: str, capacity: int) -> DataFrame:
    """(key, piece, token_start, n_tokens): a text over the capacity is divided, every other is one piece."""
    n = F.col("n_tokens")
    starts = F.when(n <= capacity, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(capacity)))
    return counts.select(key, n.alias("_n"), F.posexplode(starts).alias("piece", "token_start")).select(key, "piece", "token_start", F.least(F.col("_n") - F.col("token_start"), F.lit(capacity)).alias("n_tokens"))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", permitted: Sequence[int] = SIZES, path: str = TOKENIZER, salts: int = SALTS, pattern: str = PATTERN) -> DataFrame:
    """(key, piece, token_start, n_tokens, container_id, capacity, slot): every text's place.

    A null or empty text has no tokens and gets no container (nulls). A text is divided only if it alone exceeds the
    greatest permitted length. Repeated rows are items each. container_id counts from 0 without gaps.
    """
    spark: SparkSession = docs.sparkSession
    cap = max(permitted)
    counted = cut_lineage(token_counts(docs, key, text, path, pattern))  # tokens are counted once
    every = pieces(counted, key, cap).withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)).cast("int"))
    items = every.where("n_tokens > 0")
    cells = items.groupBy("n_tokens", "salt").agg(F.count("*").alias("c")).collect()  # at most capacity x salts rows
    hist: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for r in sorted(cells, key=lambda r: (r["n_tokens"], r["salt"])):
        base[r["n_tokens"], r["salt"]] = hist.get(r["n_tokens"], 0)
        hist[r["n_tokens"]] = hist.get(r["n_tokens"], 0) + r["c"]
    # per length the rank intervals that patterns take, in order: rank -> container = first + (rank - lo) // uses
    spans: dict[int, list[tuple[int, int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for capacity, got, times in plan(hist, permitted):
        slot = 0
        for s in dict.fromkeys(got):
            k = got.count(s)
            lo = taken.get(s, 0)
            spans.setdefault(s, []).append((lo, first, k, capacity, slot))
            taken[s] = lo + k * times
            slot += k
        first += times
    shared = spark.sparkContext.broadcast((base, {s: np.asarray(v, np.int64) for s, v in spans.items()}))  # bounded by the histogram
    w = Window.partitionBy("n_tokens", "salt").orderBy(key, "piece", "token_start")
    ranked = items.withColumn("r", F.row_number().over(w) - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, table = shared.value
        for b in batches:
            out = np.zeros((len(b), 3), np.int64)
            for i, (n, salt, r) in enumerate(zip(b["n_tokens"].tolist(), b["salt"].tolist(), b["r"].tolist(), strict=True)):
                rank = starts[n, salt] + r
                t = table[n]
                row = t[np.searchsorted(t[:, 0], rank, "right") - 1]
                out[i] = row[1] + (rank - row[0]) // row[2], row[3], row[4] + (rank - row[0]) % row[2]
            yield b[[key, "piece", "token_start", "n_tokens"]].assign(container_id=out[:, 0], capacity=out[:, 1].astype("int32"), slot=out[:, 2].astype("int32"))

    kind = dict(docs.dtypes)[key]
    placed = ranked.mapInPandas(place, f"{key} {kind}, piece int, token_start int, n_tokens int, container_id bigint, capacity int, slot int")
    none = every.where("n_tokens = 0").select(key, "piece", "token_start", "n_tokens", F.lit(None).cast("bigint").alias("container_id"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("int").alias("slot"))
    return placed.unionByName(none)


def fill_report(packed: DataFrame) -> DataFrame:
    """Per capacity: containers, pieces, tokens and the share of the capacity that stays unused."""
    one = packed.where(F.col("container_id").isNotNull()).groupBy("container_id", "capacity").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"))
    return one.groupBy("capacity").agg(F.count("*").alias("n_containers"), F.sum("k").alias("n_pieces"), F.sum("t").alias("n_tokens"), F.max("t").alias("fullest")).withColumn("unused_share", F.round(1 - F.col("n_tokens") / (F.col("capacity") * F.col("n_containers")), 6))
