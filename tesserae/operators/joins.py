"""Merges with reject reasons, lookups and link-graph steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions.text import href_to_title, truthy
from tesserae.operators.windows import last_wins


def merge_samples(qar: DataFrame, tables: DataFrame, searches: DataFrame) -> DataFrame:
    """Question records with their table and search record, and why a record is rejected (null: kept).

    Tables are one per table_id and searches one per question, the last by seq; only then the search's table must be the
    question's own. Records without a trace don't take part.
    """
    t = last_wins(tables.select("table_id", "seq", F.coalesce(F.nullif("expanded_table_html", F.lit("")), F.col("original_table_html")).alias("table_html")), ["table_id"], ["seq"]).select("table_id", "table_html", F.lit(True).alias("_t"))
    s = last_wins(searches.where(F.col("question").isNotNull()).select("question", "seq", F.col("table_id").alias("search_table_id"), "relevant_web_urls", "relevant_web_articles"), ["question"], ["seq"]).drop("seq").withColumn("_s", F.lit(True))
    j = qar.where(truthy("reasoning_traces")).join(t, "table_id", "left").join(s, "question", "left")
    reason = F.when(F.col("_t").isNull(), "no_table").when(F.col("_s").isNull(), "no_search").when(~F.coalesce(F.col("search_table_id") == F.col("table_id"), F.lit(False)), "other_table")
    return j.withColumn("reject", reason).drop("_t", "_s")


def with_documents(qar: DataFrame, searches: DataFrame) -> DataFrame:
    """Question records that have a non-empty document set for their table, the last by seq."""
    docs = searches.where(F.col("table_id").isNotNull() & (F.size("relevant_web_articles") > 0))
    d = last_wins(docs.select("table_id", "seq", "relevant_web_articles"), ["table_id"], ["seq"]).drop("seq")
    return qar.join(d, "table_id")


def fixed(records: DataFrame, fixes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Records with the columns of a fix where there is one."""
    f = fixes.select(key, *(F.col(x).alias(f"_fix_{x}") for x in columns))
    j = records.join(f, key, "left")
    return j.select(*(F.coalesce(f"_fix_{x}", x).alias(x) if x in columns else F.col(x) for x in records.columns))


def footnotes(cells: DataFrame, references: DataFrame) -> DataFrame:
    """(table_id, notes): the distinct end-of-page notes that a table's in-page links name, by id; missing ones are dropped.

    cells: table_id, page_id, href; references: page_id, ref_id, text.
    """
    ids = cells.where(F.col("href").startswith("#")).select("table_id", "page_id", F.col("href").substr(F.lit(2), F.char_length("href")).alias("ref_id")).distinct()
    got = ids.join(references, ["page_id", "ref_id"])
    return got.groupBy("table_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ref_id", "text"))), lambda x: x["text"]).alias("notes"))


def edges_of(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(src, dst, pos): a page's article links in order of appearance."""
    hrefs = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'href="([^"]*)"'), F.lit(1))
    e = pages.select(F.col(page).alias("src"), F.posexplode(hrefs).alias("pos", "href"))
    return e.withColumn("dst", href_to_title("href")).where(F.col("dst").isNotNull()).select("src", "dst", "pos")


def frontier(seeds: DataFrame, edges: DataFrame, done: DataFrame, hops: int = 1) -> DataFrame:
    """(title): seeds and what their links and back-links reach in so many hops, without the titles done already."""
    reached = seeds.select("title").distinct()
    step = reached
    for _ in range(hops):
        out = edges.join(step, edges["src"] == step["title"], "left_semi").select(F.col("dst").alias("title"))
        back = edges.join(step, edges["dst"] == step["title"], "left_semi").select(F.col("src").alias("title"))
        step = out.unionByName(back).distinct()
        reached = reached.unionByName(step).distinct()
    return reached.join(done.select("title").distinct(), "title", "left_anti")


def blocked_hits(edges: DataFrame, blocked: DataFrame) -> DataFrame:
    """(src, n_links, n_blocked): link hits, not distinct titles, that lead into the blocked set."""
    b = blocked.select(F.col("title").alias("dst")).distinct().withColumn("_b", F.lit(1))
    return edges.join(b, "dst", "left").groupBy("src").agg(F.count("*").alias("n_links"), F.count("_b").alias("n_blocked"))
