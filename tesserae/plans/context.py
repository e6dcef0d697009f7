"""Packing a question's pages and articles into its context: budgets, leads, ranking, order and assembly."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions.chunk import chunks, markdown_chunks
from tesserae.functions.text import must_keep, neutral_headings
from tesserae.functions.tokens import counter
from tesserae.operators.retrieval import compact

# The distribution of context budgets, in units of 1,024 tokens.
MEAN_K, STD_K, PER_DOCUMENT_K, LEAST, MOST = 54, 30, 3, 4096, 98304
CHUNK_WORDS = 256


def budget_and_order(item: str, n_docs: str, more: int = 0) -> Column:
    """(budget, order): a Gaussian budget that grows with the documents, clamped, and a shuffle of the positions of these
    and `more` others; both from a generator seeded by the item's ordinal, the budget drawn first."""

    def run(items: pd.Series, ns: pd.Series) -> pd.DataFrame:
        rows = []
        for i, n in zip(items.tolist(), ns.tolist(), strict=True):
            g = random.Random(i)
            b = int(1024 * (g.normalvariate(MEAN_K, STD_K) + PER_DOCUMENT_K * n))
            at = list(range(n + more))
            g.shuffle(at)
            places = [0] * len(at)
            for position, document in enumerate(at):
                places[document] = position
            rows.append((min(max(b, LEAST), MOST), places))
        return pd.DataFrame(rows, columns=["budget", "order"])

    return F.pandas_udf(run, "budget int, order array<int>")(item, n_docs)


def article_texts(questions: DataFrame, articles: DataFrame, key: str, names: str) -> DataFrame:
    """(key, doc_order, title, text) of the cached articles that a question names, in its order; missing or empty ones are left out."""
    e = questions.select(key, F.posexplode(F.col(names)).alias("doc_order", "basename"))
    return e.join(articles.select("basename", "title", F.col("page_text").alias("text")), "basename").where(F.coalesce("text", F.lit("")) != "").select(key, "doc_order", "title", "text")


def assemble(docs: DataFrame, key: str) -> DataFrame:
    """(key, context): documents in their order under numbered headings, heading markers spelled out; a lone one without a heading.

    docs: key, position, text.
    """
    g = docs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]).alias("d"))
    headed = F.transform("d", lambda x, i: F.concat(F.lit("==========\n**Document "), (i + 1).cast("string"), F.lit("**: \n\n\n"), x))
    return g.select(key, neutral_headings(F.when(F.size("d") == 1, F.col("d")[0]).otherwise(F.array_join(headed, "\n\n"))).alias("context"))


def pack_contexts(questions: DataFrame, articles: DataFrame, key: str = "sample_id", budget: int | str | None = None, chunk_words: int = CHUNK_WORDS, anchors: DataFrame | None = None, tokenizer: str | None = None) -> DataFrame:
    """(key, n_docs, budget, context) of questions with at least one cached article.

    The lead of a page is kept whatever its rank, and so is the section that the question was made from; both are
    charged to the budget. All else is chunked, ranked against the question by BM25+ and cut to what is left. The page
    of the section comes first, then the others in their order, and all are shuffled. questions: key, question,
    relevant_web_articles; budget: a number, or a column of the questions, in place of the drawn one; anchors: key, before, section, after, one row a key.
    """
    count = counter(tokenizer)
    docs = article_texts(questions, articles, key, "relevant_web_articles")
    lead = F.when(F.instr("text", "\n\n") > 0, must_keep("text")).otherwise("")
    docs = docs.withColumn("lead", lead).withColumn("rest", F.col("text").substr(F.char_length("lead") + 1, F.char_length("text"))).withColumn("after", F.lit(""))
    docs = docs.select(key, (F.row_number().over(_by(key, "doc_order")) - 1).alias("doc_order"), F.lit(False).alias("anchor"), "lead", "rest", "after")
    n = docs.groupBy(key).agg(F.count("*").cast("int").alias("n_docs"), F.sum(count("lead")).alias("_kept"))
    more = 0
    if anchors is not None:
        a = anchors.join(n.select(key), key, "left_semi").select(key, F.lit(-1).alias("doc_order"), F.lit(True).alias("anchor"), F.coalesce("section", F.lit("")).alias("lead"), F.coalesce("before", F.lit("")).alias("rest"), F.coalesce("after", F.lit("")).alias("after"))
        docs, more = docs.unionByName(a), 1
        n = n.join(a.select(key, count("lead").alias("_section")), key, "left").withColumn("_kept", F.col("_kept") + F.coalesce("_section", F.lit(0)))
    drawn = n.withColumn("_b", budget_and_order(key, "n_docs", more))
    if budget:
        own = F.col(budget) if isinstance(budget, str) else F.lit(budget)
        drawn = drawn.join(questions.select(key, own.cast("int").alias("_own")), key)
    plan = drawn.select(key, "n_docs", "_kept", F.col("_own" if budget else "_b.budget").alias("budget"), F.col("_b.order").alias("order"))
    # one document each side of a section: doc_order of the part after it comes last
    sides = docs.select(F.col(key).alias("query_id"), F.col("doc_order"), "rest").unionByName(docs.where("anchor").select(F.col(key).alias("query_id"), F.lit(1 << 30).alias("doc_order"), F.col("after").alias("rest")))
    pieces = F.flatten(F.transform(F.split("rest", "\n\n"), lambda x: F.array(x)))
    parts = sides.select("query_id", "doc_order", F.posexplode(pieces).alias("_p", "piece")).select("query_id", "doc_order", "_p", F.posexplode(chunks("piece", markdown_chunks, chunk_words)).alias("_c", "text"))
    parts = parts.select("query_id", "doc_order", F.struct("_p", "_c").alias("chunk_order"), "text")
    left = F.greatest(F.col("budget") - F.col("_kept"), F.lit(0)).alias("left")
    asked = questions.join(plan, key).select(F.col(key).alias("query_id"), F.col("question").alias("text"), left)
    bodies = compact(parts, asked, "left", count=count if tokenizer else None).withColumnRenamed("query_id", key)
    tail = bodies.where(F.col("doc_order") == 1 << 30).select(key, F.col("body").alias("_tail"))
    w = docs.drop("rest", "after").join(bodies, [key, "doc_order"], "left").join(tail, key, "left").join(plan.select(key, "order"), key)
    body, said = F.coalesce("body", F.lit("")), F.coalesce("_tail", F.lit(""))
    text = F.when(F.col("anchor"), F.concat(body, F.lit("\n"), "lead", F.lit("\n"), said)).when(F.col("lead") != "", F.concat("lead", F.lit("\n\n"), body)).otherwise(body)
    placed = w.select(key, F.get("order", F.row_number().over(_by(key, "doc_order")) - 1).alias("position"), text.alias("text"))
    return assemble(placed, key).join(plan.select(key, "n_docs", "budget"), key).select(key, "n_docs", "budget", "context")


def _by(key: str, order: str):  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


def length_filter(samples: DataFrame, trace: str, message: str, max_trace: int = 2048, max_message: int = 81920) -> DataFrame:
    """Samples whose trace and whole message stay strictly below their token limits."""
    return samples.where((F.col(trace) < max_trace) & (F.col(message) < max_message))
