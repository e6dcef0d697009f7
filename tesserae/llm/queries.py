"""The queries of the text operators, and the SQL that gives the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm import boilerplate, leakage, near_dup, packing, pairs, sentences, splitting, truncation
from tesserae.session import table

TRACES = ["llm_generated_reasoning_traces", "llm_thinking_content"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.broken_pairs(table(spark, d, "attempts"), table(spark, d, "merged_samples").select("sample_id", "final_answer_sql"))


def p1_defect_counts(spark: SparkSession, d: str) -> DataFrame:
    return p1_found(spark, d).groupBy("field", "defect").agg(F.count("*").alias("n"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.similar_pairs(table(spark, d, "qar_records").select("seq", "question"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.duplicate_groups(table(spark, d, "qar_records").select("seq", "question"))


def _attempt_texts(spark: SparkSession, d: str) -> dict:
    texts = table(spark, d, "attempts").select("seq", "sample_id", "setting", "question", *TRACES)
    return {"df": texts, "columns": TRACES, "intact": table(spark, d, "merged_samples").select("sample_id", "final_answer_sql"), "prompt": "question"}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    cut, _ = truncation.cut_values(**_attempt_texts(spark, d))
    return cut.select("seq", "field")


def p4_share(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_share(**_attempt_texts(spark, d)).withColumnRenamed("source", "setting")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.sufficient_boundary(table(spark, d, "merged_samples").select("sample_id", "context"), "sample_id", "context")


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_texts(table(spark, d, "merged_samples").select("sample_id", "context"), "sample_id", "context")


def p5_put_together(spark: SparkSession, d: str) -> DataFrame:
    """Of every divided context: whether its pieces, less their overlaps, are the context, none is too long, and each overlaps the one before by 200 characters."""
    p = p5_pieces(spark, d)
    before = F.lag("end").over(Window.partitionBy("sample_id").orderBy("piece"))
    own = p.withColumn("_b", before).withColumn("own", F.expr("substring(text, cast(coalesce(_b - start, 0) as int) + 1)"))
    g = own.groupBy("sample_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "own"))), lambda x: x["own"]), "")).alias("whole"),
        F.bool_and(F.char_length("text") <= 4000).alias("short"),
        F.bool_and(F.coalesce(F.col("_b") - F.col("start") == 200, F.lit(True))).alias("overlap"),
        F.bool_and((F.col("piece") > 0) | (F.col("start") == 0)).alias("begins"),
    )
    return g.select("sample_id", "whole", "short", "overlap", "begins")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    articles = table(spark, d, "articles")
    samples = table(spark, d, "merged_samples").select("sample_id", "relevant_web_articles", "context")
    return boilerplate.article_pages(articles).unionByName(boilerplate.context_pages(samples, articles))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.furniture_lines(_pages(spark, d))


def p6_bodies(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_bodies(_pages(spark, d))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents").select("doc_id", "text"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(packing.pack(table(spark, d, "documents").select("doc_id", "text")))


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a text, rows placed whole, containers over their capacity, and texts divided without need."""
    p = packing.pack(table(spark, d, "documents").select("doc_id", "text")).where("container_id is not null")
    full = p.groupBy("container_id", "capacity").agg(F.sum("n_tokens").alias("t")).agg(F.count_if(F.col("t") > F.least(F.col("capacity"), F.lit(packing.CAPACITY))).alias("n_over"))
    docs = p.groupBy("doc_id").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("t"), F.max("piece").alias("m")).agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("k") == F.col("m") + 1).alias("n_whole"), F.count_if((F.col("k") > 1) & (F.col("t") <= packing.CAPACITY)).alias("n_needless")
    )
    return docs.withColumn("_k", F.lit(0)).join(full.withColumn("_k", F.lit(0)), "_k").drop("_k")  # one row each


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "test_items").select("item_id", "item_text"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "test_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (p1_found, p1_defect_counts, p3_found, p3_groups, p4_found, p4_share, p5_found, p5_pieces, p5_put_together, p6_found, p6_bodies, p7_containers, p7_fill, p7_kept, p8_found, p8_report, p9_found)
    }


_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
_GRAMS = """
    g_docs AS (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT doc_id, {d} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) >= 12),
    g_items AS (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT item_id, {t} AS w FROM test_items WHERE item_text IS NOT NULL) WHERE len(w) >= 12),
    found AS (SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM g_docs) JOIN (SELECT item_id, array_to_string(w[i:i + 11], ' ') AS g FROM g_items) USING (g))
""".format(d=_WORDS.format("text"), t=_WORDS.format("item_text"))


def oracle_sql() -> dict[str, str]:
    def longest(rx: str) -> str:
        return f"list_max(list_transform(string_split_regex(context, '{rx}'), lambda x: length(x))) <= 4000"

    return {
        "p3_found": f"""
            WITH w AS (SELECT seq, list_distinct({_WORDS.format("question")}) AS w FROM qar_records WHERE question IS NOT NULL)
            SELECT a.seq AS seq_a, b.seq AS seq_b FROM w a JOIN w b ON a.seq < b.seq AND len(a.w) > 0 AND len(b.w) > 0
            WHERE 10 * len(list_intersect(a.w, b.w)) >= 7 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))""",
        "p5_found": rf"""
            SELECT sample_id, CASE WHEN {longest(r"\r?\n([ \t\r]*\n)+")} THEN 'paragraph' WHEN {longest(r"\r?\n")} THEN 'line' WHEN {longest(r"[ \t\r\n]+")} THEN 'space' ELSE 'none' END AS boundary
            FROM merged_samples WHERE length(context) > 4000""",
        "p5_put_together": "SELECT sample_id, md5(context) AS whole, true AS short, true AS overlap, true AS begins FROM merged_samples WHERE length(context) > 4000",
        "p7_kept": "SELECT count(*) AS n_docs, count(*) AS n_whole, 0::BIGINT AS n_needless, 0::BIGINT AS n_over FROM documents WHERE text <> ''",
        "p8_found": f"WITH {_GRAMS} SELECT doc_id, item_id FROM found",
        "p8_report": f"WITH {_GRAMS}, n AS (SELECT item_id, count(*) AS n_docs FROM found GROUP BY item_id) SELECT item_id, task, coalesce(n_docs, 0) AS n_docs FROM test_items LEFT JOIN n USING (item_id)",
    }
