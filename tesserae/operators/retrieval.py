"""BM25+ ranking and packing into a token budget, as joins, aggregates and windows.

score = sum over the query's terms in a chunk of idf (delta + tf (k1 + 1) / (k1 (1 - b + b dl / avgdl) + tf)) with
idf = ln((N + 1) / df). Statistics belong to a corpus: all chunks, or the chunks of one question.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.session import if_small

K1, B, DELTA = 1.5, 0.75, 1.5
BETWEEN = r"[^\p{L}\p{N}_]+"  # what stands between tokens; splitting is linear, extracting all matches copies the text for each


def tokens(text: str | Column) -> Column:
    """Runs of at least two letters, digits or underscores, in lower case."""
    return F.filter(F.split(F.lower(text if isinstance(text, Column) else F.col(text)), BETWEEN), lambda x: F.char_length(x) >= 2)


def bm25(chunks: DataFrame, queries: DataFrame, corpus: str | None = None, k1: float = K1, b: float = B, delta: float = DELTA, stopwords: list[str] | None = None) -> DataFrame:
    """(query_id, chunk_id, n_tokens, score) of every chunk that shares a term with the query.

    chunks: chunk_id, text [, corpus]; queries: query_id, text. Without a corpus column every query is held against all
    chunks; with one, query_id is the corpus, and N, df and the mean length are the corpus's own. Term frequencies are
    counted before the shuffle only for terms that some query has; a null text has no term. The queries' words and their
    frequencies go to every task if they are few (checked), so that no frequent word is a join key.
    """
    own = [corpus] if corpus else []
    q = queries.select("query_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    if stopwords:
        q = q.where(~F.col("term").isin(stopwords))
    t = chunks.select("chunk_id", *own, tokens("text").alias("_t")).where(F.col("_t").isNotNull()).withColumn("n_tokens", F.size("_t"))
    stats = t.groupBy(*own).agg(F.count("*").alias("_n"), F.avg("n_tokens").alias("_avg"))
    terms = t.select("chunk_id", *own, "n_tokens", F.explode("_t").alias("term"))
    if corpus:
        q = q.withColumnRenamed("query_id", corpus)
        tf = terms.join(q, [corpus, "term"]).groupBy(corpus, "chunk_id", "n_tokens", "term").agg(F.count("*").alias("tf"))
        df = tf.groupBy(corpus, "term").agg(F.count("*").alias("df"))
        m = tf.join(df, [corpus, "term"]).join(stats, corpus).withColumn("query_id", F.col(corpus))
    else:
        tf = terms.join(if_small(q.select("term").distinct()), "term", "left_semi").groupBy("chunk_id", "n_tokens", "term").agg(F.count("*").alias("tf"))
        df = tf.groupBy("term").agg(F.count("*").alias("df"))
        total = stats.first()
        m = tf.join(if_small(df), "term").join(if_small(q.select("term", F.col("query_id"))), "term").withColumns({"_n": F.lit(total["_n"]), "_avg": F.lit(total["_avg"])})
    idf = F.log((F.col("_n") + 1) / F.col("df"))
    part = idf * (delta + F.col("tf") * (k1 + 1) / (k1 * (1 - b + b * F.col("n_tokens") / F.col("_avg")) + F.col("tf")))
    return m.withColumn("_p", part).groupBy("query_id", "chunk_id", "n_tokens").agg(F.round(F.sum("_p"), 6).alias("score"))


def top_k(scores: DataFrame, k: int | Column) -> DataFrame:
    """The k best chunks of every query with their rank; ties by chunk."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def within_budget(scores: DataFrame, budget: int | str, all_chunks: bool = False) -> DataFrame:
    """The best chunks of every query whose running total of tokens stays within the budget, a number or a column.

    A matching chunk has at least one token, so no more than budget ranks can fit: the rank limit is applied first and
    keeps the running total from sorting all matches of a query. With all_chunks chunks may be empty, and it isn't.
    """
    budget = F.col(budget) if isinstance(budget, str) else budget
    top = top_k(scores, F.lit((1 << 31) - 1) if all_chunks else budget)
    run = F.sum("n_tokens").over(Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return top.withColumn("running", run).where(F.col("running") <= budget)


def compact(chunks: DataFrame, queries: DataFrame, budget: int | str, joiner: str = "...\n", count: Callable[[str], Column] | None = None) -> DataFrame:
    """(query_id, doc_order, body): each question's documents cut to the chunks that its budget holds.

    chunks: query_id, doc_order, chunk_order, text. A question whose chunks all fit keeps them joined by line breaks;
    else all chunks are ranked, those without a common word last and in order, and the best that fit are kept in their
    old order, joined by the mark; a document without one is ''. The budget is a number, or a column of the queries; of
    a budget of nothing or less nothing is left. count gives a text's tokens; by default those that are ranked by.
    """
    limit = F.col(budget) if isinstance(budget, str) else F.lit(budget)
    limits = queries.select("query_id", limit.alias("_limit"))
    c = chunks.withColumn("chunk_id", F.struct("doc_order", "chunk_order")).withColumn("n", count("text") if count else F.size(tokens("text")))
    total = c.groupBy("query_id").agg(F.sum("n").alias("_total"))
    c = c.join(total, "query_id").join(limits, "query_id")
    fit = (F.col("_total") <= F.col("_limit")) & (F.col("_limit") > 0)
    small, large = c.where(fit), c.where(~fit)
    fits = small.groupBy("query_id", "doc_order").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_order", "text"))), lambda x: x["text"]), "\n").alias("body"))
    s = bm25(large.select("chunk_id", F.col("query_id").alias("corpus"), "text"), queries.join(large.select("query_id").distinct(), "query_id", "left_semi"), "corpus")
    ranked = large.select("query_id", "chunk_id", F.col("n").alias("n_tokens"), "_limit").join(s.select("query_id", "chunk_id", "score"), ["query_id", "chunk_id"], "left").fillna(0.0, ["score"])
    kept = within_budget(ranked.where("_limit > 0"), "_limit", True).select("query_id", "chunk_id", F.lit(True).alias("_k"))
    j = large.join(kept, ["query_id", "chunk_id"], "left")
    cut = j.groupBy("query_id", "doc_order").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_k"), F.struct("chunk_order", "text")))), lambda x: x["text"]), joiner).alias("body"))
    return fits.unionByName(cut)
