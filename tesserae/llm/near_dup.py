"""Near-duplicate records with small edits: a prefix-tree join over globally ordered token sets.

Tokens are ordered by rising document frequency over all records. Two sets whose Jaccard similarity reaches t share a
token among the first n - ceil(t n) + 1 of each, so every set is sent to one bucket per token of that prefix. In a bucket
the sets stand in a trie; a probe walks it once, sharing the overlap counted so far among all sets below a node, and
leaves a subtree when neither the tokens that remain in the probe nor the lengths below the node can reach the overlap
needed. A pair is reported only in the bucket of its first common token. Equal sets are one class and join once; buckets
above BUCKET_ROWS are cut into blocks whose pairs of blocks are separate groups, so no task holds a hot bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.session import cut_lineage, if_small

THRESHOLD = 0.7
FREQUENT = 0.0001  # share of the records that a token must be in to be ordered by its frequency
CLASS_ROWS = 1000  # rows of a class that one task pairs with the others; a larger class is split
BUCKET_ROWS = 2000  # rows of a bucket that one group holds; a larger bucket becomes blocks of that size


def word_set(text: str) -> Column:
    """Distinct words: maximal runs of letters or digits, in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")), "")


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class, words) of every record with a non-null text; the class is a 128-bit hash of the word set."""
    w = df.where(F.col(text).isNotNull()).select(F.col(key), F.array_sort(word_set(text)).alias("words"))
    s = F.concat_ws(" ", "words")
    return w.select(key, F.concat_ws("-", F.hex(F.xxhash64(s)), F.hex(F.xxhash64(s, F.lit(1)))).alias("cls"), "words")


def ordered_sets(reps: DataFrame, share: float = FREQUENT) -> DataFrame:
    """(cls, toks): each set as token hashes, rarest first; the same order in all records.

    Any order that all records share is right, and only frequent tokens must come late, so the tokens of at least a fixed
    share of the records are counted and sent to every task (at most mean size / share), and a record is ordered where it
    is: no join meets a frequent word. Tokens below the share come first, by their hash.
    """
    hashed = reps.select("cls", F.transform("words", lambda w: F.xxhash64(w)).alias("t"))
    n = hashed.count()
    freq = hashed.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*").alias("df")).where(F.col("df") >= max(2.0, n * share))
    rank = {r["t"]: i for i, r in enumerate(sorted(freq.collect(), key=lambda r: (r["df"], r["t"])))}
    shared = reps.sparkSession.sparkContext.broadcast(rank)

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        for b in batches:
            yield pd.DataFrame({"cls": b["cls"], "toks": [sorted(t.tolist(), key=lambda x: (at.get(x, -1), x)) for t in b["t"]]})

    return hashed.mapInPandas(order, "cls string, toks array<bigint>")


class Trie:
    """Ordered token lists that share their beginnings; every node knows the longest and shortest list below it."""

    __slots__ = ("ends", "hi", "kids", "lo")

    def __init__(self) -> None:
        self.kids: dict[int, Trie] = {}
        self.ends: list[int] = []
        self.lo, self.hi = 1 << 30, 0

    def add(self, toks: list[int], i: int) -> None:
        node, n = self, len(toks)
        node.lo, node.hi = min(node.lo, n), max(node.hi, n)
        for t in toks:
            node = node.kids.setdefault(t, Trie())
            node.lo, node.hi = min(node.lo, n), max(node.hi, n)
        node.ends.append(i)

    def probe(self, toks: list[int], t: float) -> Iterator[tuple[int, int]]:
        """(index, overlap) of the lists whose Jaccard similarity with toks is at least t."""
        n = len(toks)
        at = {x: i for i, x in enumerate(toks)}
        least_len, most_len = math.ceil(t * n - 1e-9), math.floor(n / t + 1e-9)
        stack: list[tuple[Trie, int, int, int]] = [(self, 0, 0, 0)]  # node, depth, overlap, tokens of the probe passed
        while stack:
            node, depth, both, passed = stack.pop()
            if node.hi < least_len or node.lo > most_len:
                continue
            need = math.ceil(t / (1 + t) * (n + max(node.lo, least_len)) - 1e-9)
            if both + min(n - passed, min(node.hi, most_len) - depth) < need:
                continue
            for i in node.ends:
                if both >= t / (1 + t) * (n + depth) - 1e-9:
                    yield i, both
            for tok, kid in node.kids.items():
                p = at.get(tok)
                if p is None:
                    stack.append((kid, depth + 1, both, passed))
                else:
                    stack.append((kid, depth + 1, both + 1, p + 1))


def join_group(bucket: int, a: list[tuple[str, list[int]]], b: list[tuple[str, list[int]]] | None, t: float) -> list[tuple[str, str]]:
    """Pairs of class ids (less, greater) within a, or between a and b, whose first common token is the bucket's."""
    trie, out = Trie(), []
    held = a if b is None else b
    if b is not None:
        for i, (_, toks) in enumerate(b):
            trie.add(toks, i)
    for i, (cls, toks) in enumerate(a):
        if trie.hi:
            before = toks[: toks.index(bucket)]
            for j, _ in trie.probe(toks, t):
                other = held[j]
                ob = other[1][: other[1].index(bucket)]
                if other[0] != cls and not (before and ob and not set(before).isdisjoint(ob)):
                    out.append((cls, other[0]) if cls < other[0] else (other[0], cls))
        if b is None:
            trie.add(toks, i)
    return out


def similar_classes(sets: DataFrame, threshold: float = THRESHOLD, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(cls_a, cls_b), cls_a < cls_b: pairs of different token sets at or above the threshold, each once."""
    n = F.size("toks")
    prefix = F.slice(F.col("toks"), 1, F.greatest(n - F.ceil(n * threshold - 1e-9) + 1, F.lit(1)).cast("int"))
    placed = sets.where(n > 0).select("cls", "toks", F.explode(prefix).alias("bucket"))
    large = sets.where(n > 0).select(F.explode(prefix).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("rows")).where(F.col("rows") > bucket_rows)
    placed = placed.join(if_small(large), "bucket", "left")
    # a bucket of k blocks: block i meets itself and every other block; a row goes to the k groups its block is part of
    k = F.ceil(F.coalesce("rows", F.lit(1)) / bucket_rows).cast("int")
    blocked = placed.withColumn("k", k).withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    spread = blocked.select("bucket", "cls", "toks", "mine", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
    groups = spread.select("bucket", F.least("mine", "o").alias("ga"), F.greatest("mine", "o").alias("gb"), "mine", "cls", "toks")
    sorted_ = groups.repartition(F.col("bucket"), F.col("ga"), F.col("gb")).sortWithinPartitions("bucket", "ga", "gb")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, a, b = None, [], []

        def close() -> list[tuple[str, str]]:
            if key is None or len(a) + len(b) < 2:
                return []
            x, y = ([(c, t.tolist()) for c, t in side] for side in (a, b))
            return join_group(key[0], x, None if key[1] == key[2] else y, threshold)

        for pdf in batches:
            out: list[tuple[str, str]] = []
            for bucket, ga, gb, mine, cls, toks in zip(*(pdf[c].tolist() for c in ("bucket", "ga", "gb", "mine", "cls", "toks")), strict=True):
                if (bucket, ga, gb) != key:
                    out += close()
                    key, a, b = (bucket, ga, gb), [], []
                (a if mine == ga else b).append((cls, toks))
            yield pd.DataFrame(out, columns=["cls_a", "cls_b"])
        yield pd.DataFrame(close(), columns=["cls_a", "cls_b"])

    return sorted_.mapInPandas(run, "cls_a string, cls_b string")


def near_duplicates(df: DataFrame, key: str = "seq", text: str = "question", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has key and cls of every record with a non-null text, links the similar pairs of classes.

    Records without a word form one class that is similar to nothing but itself. Equal sets share a class. Both results
    are checkpointed, so the expansions below read them instead of joining again.
    """
    every = classes(df, key, text)
    reps = every.dropDuplicates(["cls"]).select("cls", "words")
    links = cut_lineage(similar_classes(cut_lineage(ordered_sets(reps)), threshold))
    return every.select(key, "cls", (F.size("words") > 0).alias("has_words")), links


def similar_pairs(df: DataFrame, key: str = "seq", text: str = "question", threshold: float = THRESHOLD) -> DataFrame:
    """(key_a, key_b), key_a < key_b: every pair of records at or above the threshold, copies included.

    Pairs of copies are as many as the square of their class, which the form of the result demands; a class of more than
    CLASS_ROWS is split over as many tasks as it has such parts. duplicate_groups() gives the same without the square.
    """
    members, links = near_duplicates(df, key, text, threshold)
    members = members.where("has_words").select(F.col(key).alias("_m"), "cls")
    large = members.groupBy("cls").agg(F.count("*").alias("_n")).where(F.col("_n") > CLASS_ROWS)
    members = members.join(if_small(large), "cls", "left").withColumn("_k", F.ceil(F.coalesce("_n", F.lit(1)) / CLASS_ROWS).cast("int"))
    left = members.select(F.col("_m").alias("a"), F.col("cls").alias("cls_a"), F.pmod(F.xxhash64("_m"), F.col("_k")).cast("int").alias("part"))
    right = members.select(F.col("_m").alias("b"), F.col("cls").alias("cls_b"), "_k")
    every = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).drop("_k")
    copies = left.join(every, (F.col("cls_a") == F.col("cls_b")) & (left["part"] == every["part"])).where(F.col("a") < F.col("b")).select(F.col("a").alias(f"{key}_a"), F.col("b").alias(f"{key}_b"))
    across = links.join(left.drop("part"), "cls_a").join(right.drop("_k"), "cls_b").select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))
    return across.unionByName(copies)


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, comp): connected components of (u, v) by alternating large-star and small-star; comp is the least node."""
    e = cut_lineage(edges.select("u", "v").where("u <> v").distinct())
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(m, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        m2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(m2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m2.select("u", F.col("m").alias("v")))
        nxt = cut_lineage(small.where("u <> v").distinct())
        same = nxt.count() == e.count() and nxt.exceptAll(e).isEmpty()
        e = nxt
        if same:
            break
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def duplicate_groups(df: DataFrame, key: str = "seq", text: str = "question", threshold: float = THRESHOLD) -> DataFrame:
    """One row per record: its class of equal sets, the group of linked classes, and the number of classes it is linked to.

    A record with a null text has null class and group and no link.
    """
    members, links = near_duplicates(df, key, text, threshold)
    comp = components(links.select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v")))
    n = links.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    got = members.join(comp, F.col("cls") == F.col("node"), "left").join(n, "cls", "left")
    got = got.select(key, "cls", F.coalesce("comp", "cls").alias("grp"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return df.select(key).join(got, key, "left").select(key, F.col("cls").alias("class_id"), F.col("grp").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
