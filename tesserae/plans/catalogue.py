"""All queries of the core library by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import chunk, text, tokens
from tesserae.operators import adhoc, aggregates, cells, joins, retrieval, units, windows
from tesserae.plans import context, generation, pages
from tesserae.session import spread, table
from tesserae.sources import html
from tesserae.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  # the one that bpe_lengths counts with
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return units.common_units(table(spark, d, "merged_samples"))


@query("SELECT 0::BIGINT AS sample_id, 0 AS row_idx, 0 AS col_idx, '' AS digits, '' AS unit, '' AS reject WHERE false")
def p2_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Values beyond the range of a base value; the tables have none."""
    return units.rejected_values(table(spark, d, "merged_samples"))


# Retrieval

_TOK = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(text.STOPWORDS))
_BM25 = f"""
    t AS (SELECT doc_id AS chunk_id, {_TOK.format("text")} AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT count(*) AS n, avg(len(w)) AS a FROM t),
    q AS (SELECT * FROM (SELECT DISTINCT item_id AS query_id, unnest({_TOK.format("item_text")}) AS term FROM test_items) WHERE term NOT IN ({_STOP})),
    tf AS (SELECT chunk_id, len(w) AS n_tokens, term, count(*) AS tf FROM (SELECT chunk_id, w, unnest(w) AS term FROM t) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    sc AS (SELECT query_id, chunk_id, n_tokens, round(sum(ln((n + 1) / df) * (1.5 + tf * 2.5 / (1.5 * (0.25 + 0.75 * n_tokens / a) + tf))), 6) AS score
           FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sc)"""


def _scores(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text"))
    return retrieval.bm25(docs, table(spark, d, "test_items").select(F.col("item_id").alias("query_id"), F.col("item_text").alias("text")), stopwords=text.STOPWORDS)


@query(f"WITH {_BM25} SELECT query_id, rank, chunk_id, round(score, 2) AS score FROM r WHERE rank <= 10")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.top_k(_scores(spark, d), 10).select("query_id", "rank", "chunk_id", F.round("score", 2).alias("score"))


@query(f"WITH {_BM25} SELECT query_id, rank, chunk_id, running FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY query_id ORDER BY rank) AS running FROM r) WHERE running <= 2000")
def bm25_budget_context(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.within_budget(_scores(spark, d), 2000).select("query_id", "rank", "chunk_id", "running")


@query(f"""
    WITH p AS (SELECT sample_id, question, string_split(context, chr(10) || chr(10)) AS a FROM merged_samples WHERE context IS NOT NULL),
    c AS (SELECT sample_id, unnest(range(len(a))) AS i, a FROM p),
    t AS (SELECT sample_id, i, {_TOK.format("a[i + 1]")} AS w FROM c),
    s AS (SELECT sample_id, count(*) AS n, avg(len(w)) AS a FROM t GROUP BY sample_id),
    q AS (SELECT DISTINCT sample_id, unnest({_TOK.format("question")}) AS term FROM merged_samples),
    tf AS (SELECT sample_id, i, len(w) AS n_tokens, term, count(*) AS tf FROM (SELECT sample_id, i, w, unnest(w) AS term FROM t) GROUP BY ALL),
    df AS (SELECT sample_id, term, count(*) AS df FROM tf GROUP BY ALL),
    sc AS (SELECT sample_id, i, n_tokens, round(sum(ln((n + 1) / df) * (1.5 + tf * 2.5 / (1.5 * (0.25 + 0.75 * n_tokens / a) + tf))), 6) AS score
           FROM q JOIN tf USING (sample_id, term) JOIN df USING (sample_id, term) JOIN s USING (sample_id) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, i) AS rank FROM sc)
    SELECT sample_id, rank, i AS chunk_order FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY sample_id ORDER BY rank) AS running FROM r) WHERE running <= 300""")
def bm25_per_question(spark: SparkSession, d: str) -> DataFrame:
    m = spread(table(spark, d, "merged_samples").select("sample_id", "question", "context"))
    c = m.select(F.col("sample_id").alias("corpus"), F.posexplode(F.split("context", "\n\n")).alias("chunk_id", "text"))
    s = retrieval.bm25(c, m.select(F.col("sample_id").alias("query_id"), F.col("question").alias("text")), "corpus")
    return retrieval.within_budget(s, 300).select(F.col("query_id").alias("sample_id"), "rank", F.col("chunk_id").alias("chunk_order"))


@query(f"""
    WITH c AS (SELECT sample_id, unnest(range(len(a))) AS i, a, a[i + 1] AS x FROM (SELECT sample_id, string_split(context, chr(10) || chr(10)) AS a FROM merged_samples WHERE context IS NOT NULL)),
    t AS (SELECT sample_id, i, x, {_TOK.format("x")} AS w FROM c),
    s AS (SELECT sample_id, count(*) AS n, avg(len(w)) AS a, sum(len(w)) AS total FROM t GROUP BY sample_id),
    q AS (SELECT DISTINCT sample_id, unnest({_TOK.format("question")}) AS term FROM merged_samples),
    tf AS (SELECT sample_id, i, len(w) AS n_tokens, term, count(*) AS tf FROM (SELECT sample_id, i, w, unnest(w) AS term FROM t) GROUP BY ALL),
    df AS (SELECT sample_id, term, count(*) AS df FROM tf GROUP BY ALL),
    sc AS (SELECT sample_id, i, round(sum(ln((n + 1) / df) * (1.5 + tf * 2.5 / (1.5 * (0.25 + 0.75 * n_tokens / a) + tf))), 6) AS score
           FROM q JOIN tf USING (sample_id, term) JOIN df USING (sample_id, term) JOIN s USING (sample_id) GROUP BY ALL),
    r AS (SELECT t.sample_id, t.i, x, len(w) AS n_tokens, row_number() OVER (PARTITION BY t.sample_id ORDER BY coalesce(score, 0) DESC, t.i) AS rank FROM t LEFT JOIN sc USING (sample_id, i)),
    k AS (SELECT *, sum(n_tokens) OVER (PARTITION BY sample_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS running FROM r)
    SELECT sample_id, CASE WHEN total <= 300 THEN string_agg(x, chr(10) ORDER BY i) ELSE coalesce(string_agg(x, '...' || chr(10) ORDER BY i) FILTER (running <= 300), '') END AS body
    FROM k JOIN s USING (sample_id) GROUP BY sample_id, total""")
def paragraph_compaction(spark: SparkSession, d: str) -> DataFrame:
    """Each context's paragraphs, all of them ranked, cut to 300 tokens."""
    m = spread(table(spark, d, "merged_samples").select("sample_id", "question", "context"))
    c = m.select(F.col("sample_id").alias("query_id"), F.lit(0).alias("doc_order"), F.posexplode(F.split("context", "\n\n")).alias("chunk_order", "text"))
    return retrieval.compact(c, m.select(F.col("sample_id").alias("query_id"), F.col("question").alias("text")), 300).select(F.col("query_id").alias("sample_id"), "body")


@query()
def context_compaction(spark: SparkSession, d: str) -> DataFrame:
    m = spread(table(spark, d, "merged_samples").select("sample_id", "question", "context"))
    c = m.where("context is not null").select(F.col("sample_id").alias("query_id"), F.posexplode(F.split("context", "==========\n")).alias("doc_order", "t"))
    c = c.select("query_id", "doc_order", F.posexplode(chunk.chunks("t", chunk.markdown_chunks, 64)).alias("chunk_order", "text"))
    return retrieval.compact(c, m.select(F.col("sample_id").alias("query_id"), F.col("question").alias("text")), 400)


@query()
def packed_contexts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "merged_samples")
    anchors = m.select("sample_id", F.col("metadata.caption").alias("before"), F.col("df_md").alias("section"), F.lit("").alias("after"))
    return context.pack_contexts(m.select("sample_id", "question", "relevant_web_articles"), table(spark, d, "articles"), anchors=anchors)


@query("""
    WITH n AS (SELECT sample_id, count(*) AS n_docs FROM (SELECT sample_id, unnest(relevant_web_articles) AS basename FROM merged_samples) JOIN articles USING (basename) WHERE coalesce(page_text, '') <> '' GROUP BY sample_id)
    SELECT sample_id, n_docs::INTEGER AS n_docs, true AS in_budget, n_docs + 1 AS n_headings, true AS has_section FROM n""")
def packed_context_checks(spark: SparkSession, d: str) -> DataFrame:
    """Of every packed context: whether the budget lies in its bounds, its numbered headings, and whether it holds the table it was asked about."""
    got = packed_contexts(spark, d).join(table(spark, d, "merged_samples").select("sample_id", text.neutral_headings(F.coalesce("df_md", F.lit(""))).alias("_s")), "sample_id")
    headings = F.size(F.regexp_extract_all("context", F.lit(r"==========\n\*\*Document \d+\*\*: \n"), 0)).cast("bigint")
    return got.select("sample_id", "n_docs", F.col("budget").between(context.LEAST, context.MOST).alias("in_budget"), headings.alias("n_headings"), F.contains("context", "_s").alias("has_section"))


# Windows and aggregates

@query("SELECT l_orderkey, l_linenumber, running FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS running FROM lineitem) WHERE running <= 100")
def budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    return windows.budget_prefix(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_quantity", 100).select("l_orderkey", "l_linenumber", "running")


@query("SELECT seq, table_id, question FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY seq) AS r FROM qar_records WHERE coalesce(reasoning_traces, '') <> '' AND table_id IS NOT NULL) WHERE r <= 2")
def first_two_per_table(spark: SparkSession, d: str) -> DataFrame:
    return windows.first_k(table(spark, d, "qar_records").where(text.truthy("reasoning_traces")), ["table_id"], ["seq"], 2).select("seq", "table_id", "question")


_RATES = "SELECT question, count(*) AS total, CAST(sum(coalesce(answer_comparison::int, 0)) AS BIGINT) AS matches, count(*) FILTER (answer_comparison IS NULL) AS unjudged, round(sum(coalesce(answer_comparison::int, 0)) / count(*), 6) AS rate FROM attempts GROUP BY question"
_BUCKET = "CASE WHEN matches = 0 THEN 'failed' WHEN matches / total > 0.8 THEN 'easy' ELSE 'hard' END"


@query(f"SELECT *, bucket = 'hard' AS kept FROM (SELECT *, {_BUCKET} AS bucket FROM ({_RATES}))")
def match_rate_buckets(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.match_rates(table(spark, d, "attempts"), "question", "answer_comparison")


@query(f"SELECT *, bucket <> 'easy' AS kept FROM (SELECT *, {_BUCKET} AS bucket FROM ({_RATES}))")
def match_rate_student(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.match_rates(table(spark, d, "attempts"), "question", "answer_comparison", keep_failed=True)


_HARD = f"(SELECT question FROM (SELECT *, {_BUCKET} AS bucket FROM ({_RATES})) WHERE bucket = 'hard')"


@query(f"SELECT seq, question, setting, attempt_no FROM (SELECT *, row_number() OVER (PARTITION BY question, setting ORDER BY attempt_no, seq) AS r FROM attempts WHERE answer_comparison AND question IN {_HARD}) WHERE r = 1")
def first_correct_per_setting(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "attempts").select("seq", "question", "setting", "attempt_no", "answer_comparison")
    kept = aggregates.match_rates(a, "question", "answer_comparison").where("kept")
    return aggregates.first_match(a, kept, "question", "answer_comparison", ["setting"], ["attempt_no", "seq"]).select("seq", "question", "setting", "attempt_no")


@query(f"SELECT seq, question, setting, attempt_no FROM attempts WHERE answer_comparison AND question IN {_HARD}")
def teacher_matches(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "attempts").select("seq", "question", "setting", "attempt_no", "answer_comparison")
    kept = aggregates.match_rates(a, "question", "answer_comparison").where("kept")
    return aggregates.all_matches(a, kept, "question", "answer_comparison").select("seq", "question", "setting", "attempt_no")


_LEN = "len(regexp_extract_all(coalesce({0}, ''), '\\S+'))"
_DESCRIBE = "SELECT '{0}' AS name, count({0}) AS n, round(avg({0}), 6) AS mean, round(stddev_samp({0}), 6) AS std, min({0})::double AS min, quantile_cont({0}, 0.25)::double AS p25, quantile_cont({0}, 0.5)::double AS p50, quantile_cont({0}, 0.75)::double AS p75, max({0})::double AS max FROM l"


@query(f"WITH l AS (SELECT {_LEN.format('llm_generated_reasoning_traces')} AS trace_tokens, {_LEN.format('question')} + {_LEN.format('final_answer_sql')} + {_LEN.format('llm_generated_reasoning_traces')} AS message_tokens FROM attempts) {_DESCRIBE.format('trace_tokens')} UNION ALL {_DESCRIBE.format('message_tokens')}")
def describe_lengths(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.describe(_lengths(spark, d), ["trace_tokens", "message_tokens"])


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    n = text.word_count
    t = n("llm_generated_reasoning_traces")
    return table(spark, d, "attempts").select("seq", t.alias("trace_tokens"), (n("question") + n("final_answer_sql") + t).alias("message_tokens"))


@query(f"SELECT seq, trace_tokens, message_tokens FROM (SELECT seq, {_LEN.format('llm_generated_reasoning_traces')} AS trace_tokens, {_LEN.format('question')} + {_LEN.format('final_answer_sql')} + {_LEN.format('llm_generated_reasoning_traces')} AS message_tokens FROM attempts) WHERE trace_tokens < 60 AND message_tokens < 100")
def length_filter(spark: SparkSession, d: str) -> DataFrame:
    return context.length_filter(_lengths(spark, d), "trace_tokens", "message_tokens", 60, 100)


@query("SELECT o_orderkey, ordinal, CAST((7 * (ordinal + 1) + n - 1) // n AS INTEGER) AS slice FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, count(*) OVER () AS n FROM orders)")
def partition_slices(spark: SparkSession, d: str) -> DataFrame:
    return windows.slices(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7, buckets=16).select("o_orderkey", "ordinal", "slice")


@query("SELECT event_id, user_id FROM events WHERE event_id > (SELECT min(event_id) FROM events WHERE user_id = (SELECT arg_max(user_id, event_id) FROM events WHERE event_type = 'purchase'))")
def resume_after(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return windows.resume_after(e, e.where("event_type = 'purchase'"), "user_id", "event_id").select("event_id", "user_id")


@query("SELECT seq, table_id FROM qar_records WHERE table_id NOT IN (SELECT table_id FROM websearch WHERE table_id IS NOT NULL) AND table_id IS NOT NULL")
def not_searched_yet(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "qar_records").where("table_id is not null")
    return windows.not_done(q, table(spark, d, "websearch").where("table_id is not null"), "table_id").select("seq", "table_id")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    return ingest.windowed_counts(table(spark, d, "events"))


# Merges and links

_MERGE = """
    WITH t AS (SELECT table_id, coalesce(nullif(expanded_table_html, ''), original_table_html) AS table_html FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY seq DESC) AS r FROM wiki_tables) WHERE r = 1),
    s AS (SELECT question, table_id AS search_table_id, relevant_web_articles FROM (SELECT *, row_number() OVER (PARTITION BY question ORDER BY seq DESC) AS r FROM websearch WHERE question IS NOT NULL) WHERE r = 1),
    j AS (SELECT q.seq, q.table_id, q.question, md5(t.table_html) AS table_md5, len(s.relevant_web_articles) AS n_articles,
          CASE WHEN t.table_id IS NULL THEN 'no_table' WHEN s.question IS NULL THEN 'no_search' WHEN coalesce(s.search_table_id = q.table_id, false) = false THEN 'other_table' END AS reject
          FROM qar_records q LEFT JOIN t ON q.table_id = t.table_id LEFT JOIN s ON q.question = s.question WHERE coalesce(q.reasoning_traces, '') <> '')"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "qar_records").select("seq", "table_id", "question", "reasoning_traces")
    return joins.merge_samples(q, table(spark, d, "wiki_tables"), table(spark, d, "websearch"))


@query(f"{_MERGE} SELECT seq, table_id, question, table_md5, n_articles FROM j WHERE reject IS NULL")
def merge_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).where("reject is null").select("seq", "table_id", "question", F.md5("table_html").alias("table_md5"), F.when(F.col("relevant_web_articles").isNotNull(), F.size("relevant_web_articles")).alias("n_articles"))


@query(f"{_MERGE} SELECT coalesce(reject, 'kept') AS reason, count(*) AS n FROM j GROUP BY ALL")
def merge_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).groupBy(F.coalesce("reject", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT q.seq, q.table_id, len(d.relevant_web_articles) AS n_articles FROM qar_records q JOIN
    (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY seq DESC) AS r FROM websearch WHERE table_id IS NOT NULL AND len(relevant_web_articles) > 0) WHERE r = 1) d ON q.table_id = d.table_id""")
def merge_with_documents(spark: SparkSession, d: str) -> DataFrame:
    return joins.with_documents(table(spark, d, "qar_records").select("seq", "table_id"), table(spark, d, "websearch")).select("seq", "table_id", F.size("relevant_web_articles").alias("n_articles"))


_EDGES = """e AS (SELECT src, pos, nullif(string_split(replace(url_decode(substr(href, 7)), '_', ' '), '#')[1], '') AS dst FROM
    (SELECT page_metadata.page_title AS src, unnest(range(len(h))) AS pos, h, h[pos + 1] AS href FROM (SELECT page_metadata, regexp_extract_all(coalesce(original_table_html, ''), 'href="([^"]*)"', 1) AS h FROM wiki_tables)) WHERE href LIKE '/wiki/%')"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return joins.edges_of(table(spark, d, "wiki_tables").select(F.col("page_metadata.page_title").alias("t"), "original_table_html"), "t", "original_table_html")


@query(f"WITH {_EDGES} SELECT src, dst, pos FROM e")
def link_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query(f"""WITH {_EDGES}, seeds AS (SELECT DISTINCT page_metadata.page_title AS title FROM wiki_tables WHERE table_metadata.hatnote IS NOT NULL),
    done AS (SELECT DISTINCT page_metadata.page_title AS title FROM wiki_tables WHERE table_metadata.hatnote IS NULL)
    SELECT DISTINCT title FROM (SELECT title FROM seeds UNION SELECT dst FROM e WHERE src IN (FROM seeds) UNION SELECT src FROM e WHERE dst IN (FROM seeds)) WHERE title NOT IN (FROM done)""")
def frontier_expand(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "wiki_tables").select(F.col("page_metadata.page_title").alias("title"), F.col("table_metadata.hatnote").alias("h"))
    return joins.frontier(w.where("h is not null"), _edges(spark, d), w.where("h is null"))


@query(f"WITH {_EDGES}, b AS (SELECT DISTINCT unnest(new_evidence_wikipages) AS title FROM wiki_tables) SELECT src, count(*) AS n_links, count(b.title) AS n_blocked FROM e LEFT JOIN b ON e.dst = b.title GROUP BY src")
def frontier_blocked_hits(spark: SparkSession, d: str) -> DataFrame:
    return joins.blocked_hits(_edges(spark, d), table(spark, d, "wiki_tables").select(F.explode("new_evidence_wikipages").alias("title")))


@query("SELECT DISTINCT u AS url, substr(regexp_replace(u, '[^a-zA-Z0-9]', '-', 'g'), 1, 246) AS cache_key FROM (SELECT unnest(relevant_web_urls) AS u FROM websearch)")
def url_cache_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "websearch").select(F.explode("relevant_web_urls").alias("url")).distinct().select("url", text.url_key("url").alias("cache_key"))


@query("""SELECT table_id, seq, note_no, json_extract_string(n, '$[0]') AS note FROM (SELECT table_id, seq, unnest(range(len(a))) AS note_no, a, a[note_no + 1] AS n
    FROM (SELECT table_id, seq, json_extract(table_metadata.references_content, '$[*]') AS a FROM wiki_tables WHERE table_metadata.references_content IS NOT NULL))""")
def table_references(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "wiki_tables").where("table_metadata.references_content is not null")
    return w.select("table_id", "seq", F.posexplode(F.from_json("table_metadata.references_content", "array<string>")).alias("note_no", "n")).select("table_id", "seq", "note_no", F.get_json_object("n", "$[0]").alias("note"))


@query("SELECT seq, coalesce(string_agg(page_text, chr(10) ORDER BY pos), '') AS texts FROM (SELECT seq, unnest(range(len(relevant_web_articles))) AS pos, relevant_web_articles AS a FROM websearch WHERE len(relevant_web_articles) > 0) w JOIN articles ON basename = a[pos + 1] WHERE coalesce(page_text, '') <> '' GROUP BY seq")
def cached_articles(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "websearch").select("seq", "relevant_web_articles")
    t = context.article_texts(w, table(spark, d, "articles"), "seq", "relevant_web_articles")
    return t.groupBy("seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_order", "text"))), lambda x: x["text"]), "\n").alias("texts"))


# Tables as cells

_CELLS = r"""rows AS (SELECT seq, unnest(range(len(r))) AS i, r FROM (SELECT seq, regexp_extract_all({0}, '(?s)<tr>(.*?)</tr>', 1) AS r FROM wiki_tables WHERE {0} <> '')),
    raw AS (SELECT seq, i, unnest(range(len(c))) AS j, c FROM (SELECT seq, i, regexp_extract_all(r[i + 1], '(?s)<t[hd]>(.*?)</t[hd]>', 1) AS c FROM rows)),
    names AS (SELECT seq, j, c[j + 1] AS col_name FROM raw WHERE i = 0),
    cells AS (SELECT seq, CAST(i - 1 AS INTEGER) AS row_idx, CAST(j AS INTEGER) AS col_idx, trim(regexp_replace(col_name, '\s*\[[^\]]*\]', '', 'g')) AS col_name,
      nullif(coalesce(nullif(trim(regexp_replace(trim(regexp_replace(x, '<[^>]*>', '', 'g')), '\s*\[[^\]]*\]', '', 'g')), ''), trim(regexp_replace(x, '<[^>]*>', '', 'g'))), '') AS text, nullif(regexp_extract(x, 'href="([^"]*)"', 1), '') AS href
      FROM (SELECT seq, i, j, replace(c[j + 1], '&amp;', '&') AS x FROM raw WHERE i > 0) JOIN names USING (seq, j))"""
_ORIGINAL = _CELLS.format("original_table_html")


def _cells(spark: SparkSession, d: str, which: str = "original_table_html") -> DataFrame:
    return html.cells(table(spark, d, "wiki_tables").where(F.col(which) != ""), "seq", which)


@query(f"WITH {_ORIGINAL} SELECT * FROM cells")
def html_table_cells(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)


_GATE = f"""WITH {_ORIGINAL}, g AS (SELECT seq, max(row_idx) + 1 AS n_rows, max(col_idx) + 1 AS n_cols, count(*) FILTER (text IS NULL) AS n_null, count(DISTINCT col_name) AS n_names FROM cells GROUP BY seq),
    k AS (SELECT *, n_rows + n_cols >= 4 AND n_null = 0 AND n_names = n_cols AS regular, n_rows BETWEEN 5 AND 30 AND n_cols BETWEEN 2 AND 8 AND n_rows * n_cols <= 150 AS ideal FROM g)"""


@query(f"{_GATE} SELECT * FROM k")
def table_gate(spark: SparkSession, d: str) -> DataFrame:
    return cells.gate(_cells(spark, d), "seq")


@query(f"{_GATE} SELECT w.seq, n_rows, n_cols FROM wiki_tables w JOIN k USING (seq) WHERE coalesce(w.expanded_table_html, '') <> '' OR ideal")
def good_tables(spark: SparkSession, d: str) -> DataFrame:
    return cells.good_tables(table(spark, d, "wiki_tables").select("seq", "expanded_table_html"), _cells(spark, d), "seq").select("seq", "n_rows", "n_cols")


@query(f"WITH {_ORIGINAL} SELECT seq, col_idx, col_name, CASE WHEN count(text) = 0 THEN 'empty' WHEN bool_and(text IS NULL OR regexp_full_match(text, '\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*')) THEN 'numeric' ELSE 'text' END AS inferred FROM cells GROUP BY ALL")
def infer_column_types(spark: SparkSession, d: str) -> DataFrame:
    return cells.column_types(_cells(spark, d), "seq")


@query(f"""WITH {_ORIGINAL}, f AS (SELECT seq, col_idx, col_name, avg((href LIKE '/wiki/%')::int) AS fraction, list(replace(substr(href, 7), '_', ' ') ORDER BY row_idx) AS titles FROM (SELECT * REPLACE (coalesce(href, '') AS href) FROM cells) GROUP BY ALL)
    SELECT seq, col_name, fraction, titles FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY col_idx) AS r FROM f WHERE fraction >= 1) WHERE r = 1""")
def reference_columns(spark: SparkSession, d: str) -> DataFrame:
    return cells.reference_columns(_cells(spark, d), "seq")


@query(f"""WITH {_ORIGINAL.replace("rows AS", "rows AS", 1)}, o AS (SELECT DISTINCT seq, col_name FROM cells), {_CELLS.format("expanded_table_html").replace("rows AS", "rows2 AS").replace("FROM rows)", "FROM rows2)").replace("raw AS", "raw2 AS").replace("FROM raw", "FROM raw2").replace("names AS", "names2 AS").replace("JOIN names", "JOIN names2").replace("cells AS", "x AS")},
    new AS (SELECT seq, row_idx, col_idx, col_name, CASE WHEN lower(trim(text)) IN ('none', 'nan', 'na', 'n/a', '') THEN NULL ELSE trim(text) END AS v FROM x ANTI JOIN o USING (seq, col_name)),
    col AS (SELECT seq, col_idx FROM new GROUP BY ALL HAVING count(DISTINCT v) >= 2),
    loose AS (SELECT DISTINCT n.seq FROM new n JOIN col USING (seq, col_idx) JOIN wiki_tables w USING (seq) WHERE v IS NOT NULL AND NOT contains(lower(w.notes), lower(v))
      AND NOT list_bool_and(list_transform(list_filter(list_transform(regexp_split_to_array(lower(v), '[,;)(]'), lambda t: trim(t)), lambda t: t <> ''), lambda t: contains(lower(w.notes), t))))
    SELECT s.seq, CASE WHEN coalesce(n_new, 0) = 0 THEN 'no_new_column' WHEN loose.seq IS NOT NULL THEN 'not_in_summary' ELSE 'ok' END AS verdict, coalesce(n_new, 0) AS n_new
    FROM (SELECT DISTINCT seq FROM x) s LEFT JOIN (SELECT seq, count(*) AS n_new FROM col GROUP BY seq) c USING (seq) LEFT JOIN loose USING (seq)""")
def validate_expansion(spark: SparkSession, d: str) -> DataFrame:
    x = _cells(spark, d, "expanded_table_html")
    s = x.select("seq", "row_idx").distinct().join(table(spark, d, "wiki_tables").select("seq", F.coalesce("notes", F.lit("")).alias("summary")), "seq")
    return cells.validate_expansion(_cells(spark, d).join(x.select("seq").distinct(), "seq", "left_semi"), x, s, "seq")


def _supplier_cells(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").withColumn("row_idx", (F.col("s_suppkey") / 2).cast("int")).withColumn("h", (F.col("s_suppkey") % 2).cast("int"))
    name = lambda n: F.when(F.col("h") == 0, n).otherwise(f"{n}.1")
    a = F.struct((F.col("h") * 2).alias("col_idx"), name("key").alias("col_name"), F.col("s_suppkey").cast("string").alias("text"))
    b = F.struct((F.col("h") * 2 + 1).alias("col_idx"), name("name").alias("col_name"), F.col("s_name").alias("text"))
    return s.select(F.lit(1).alias("t"), "row_idx", F.explode(F.array(a, b)).alias("s")).select("t", "row_idx", "s.*")


@query("""WITH k AS (SELECT *, s_suppkey // 2 AS i, s_suppkey % 2 AS h FROM supplier), n AS (SELECT max(i) + 1 AS n FROM k)
    SELECT CAST(h * n + i AS INTEGER) AS row_idx, 'key' AS col_name, s_suppkey::varchar AS text FROM k, n UNION ALL SELECT CAST(h * n + i AS INTEGER), 'name', s_name FROM k, n""")
def unfold_columns(spark: SparkSession, d: str) -> DataFrame:
    return cells.unfold(_supplier_cells(spark, d), "t").select("row_idx", "col_name", "text")


@query("SELECT r_name AS region, n_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def footer_split(spark: SparkSession, d: str) -> DataFrame:
    """Each region's nations as a table of three columns that ends in a footer row of one repeated text."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = n.select(F.col("r_name").alias("region"), F.row_number().over(windows.Window.partitionBy("r_name").orderBy("n_nationkey")).alias("row_idx"), F.array("n_name", F.col("n_nationkey").cast("string"), "r_name").alias("c"))
    foot = table(spark, d, "region").select(F.col("r_name").alias("region"), F.lit(1000).alias("row_idx"), F.array(F.lit("Total"), F.lit("Total"), F.lit("all")).alias("c"))
    c = body.unionByName(foot).select("region", "row_idx", F.posexplode("c").alias("col_idx", "text")).withColumn("col_name", F.col("col_idx").cast("string"))
    rank = F.dense_rank().over(windows.Window.partitionBy("region").orderBy("row_idx")) - 1
    kept, _ = cells.split_footer(c.withColumn("row_idx", rank), "region")
    return kept.where("col_idx = 0").select("region", "text")


@query("""WITH l AS (SELECT seq, list_filter(list_transform(string_split(df, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM qar_records WHERE df IS NOT NULL),
    h AS (SELECT seq, string_split(regexp_replace(l[1], '^\\||\\|$', '', 'g'), '|') AS h, list_filter(l[2:], lambda x: NOT regexp_matches(x, '^[|:\\-\\s]+$')) AS b FROM l WHERE len(l) >= 2),
    r AS (SELECT seq, h, i, string_split(regexp_replace(b[i + 1], '^\\||\\|$', '', 'g'), '|') AS c FROM (SELECT seq, h, b, unnest(range(len(b))) AS i FROM h)),
    c AS (SELECT seq, i, h, c, unnest(range(len(c))) AS j FROM r)
    SELECT seq, CAST(i AS INTEGER) AS row_idx, CAST(j AS INTEGER) AS col_idx, trim(h[j + 1]) AS col_name, nullif(trim(c[j + 1]), '') AS text FROM c WHERE j < len(h)""")
def markdown_table_cells(spark: SparkSession, d: str) -> DataFrame:
    return cells.from_markdown(table(spark, d, "qar_records"), "seq", "df")


@query("WITH " + _ORIGINAL + """, r AS (SELECT seq, row_idx, '| ' || string_agg(coalesce(text, ''), ' | ' ORDER BY col_idx) || ' |' AS line, '| ' || string_agg(col_name, ' | ' ORDER BY col_idx) || ' |' AS head, '| ' || string_agg('---', ' | ' ORDER BY col_idx) || ' |' AS rule FROM cells GROUP BY ALL)
    SELECT seq, first(head) || chr(10) || first(rule) || chr(10) || string_agg(line, chr(10) ORDER BY row_idx) AS markdown FROM r GROUP BY seq""")
def html_to_markdown_tables(spark: SparkSession, d: str) -> DataFrame:
    return cells.to_markdown(_cells(spark, d), "seq")


@query(f"WITH {_ORIGINAL} SELECT seq, row_idx, col_idx, col_name, text FROM cells")
def html_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Cells written as HTML tables and read again."""
    return html.cells(cells.to_html(_cells(spark, d), "seq"), "seq", "html").drop("href")


@query(f"""WITH {_ORIGINAL}, k AS (SELECT seq, col_idx, CASE WHEN count(text) = 0 THEN 'empty' WHEN bool_and(text IS NULL OR regexp_full_match(text, '\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*')) THEN 'numeric' ELSE 'text' END AS t, max(row_idx) + 1 AS n FROM cells GROUP BY ALL)
    SELECT seq AS page_id, 1 AS ordinal, max(n)::INTEGER AS n_rows, count(*)::INTEGER AS n_cols, string_agg(t, ',' ORDER BY col_idx) AS types FROM k GROUP BY seq""")
def page_records(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "wiki_tables").where("original_table_html <> ''").select(F.col("seq").alias("page_id"), F.col("original_table_html").alias("html"))
    return pages.page_records(p).select("page_id", "ordinal", F.col("n_rows").cast("int").alias("n_rows"), F.col("n_cols").cast("int").alias("n_cols"), F.array_join("types", ",").alias("types"))


@query("""SELECT c_custkey, 'Account' AS section, CAST(0 AS INTEGER) AS item_idx, 'Name' AS label, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'Account', 1, 'Nation', c_nationkey::varchar FROM customer UNION ALL SELECT c_custkey, 'Market', 0, 'Segment', c_mktsegment FROM customer""")
def infobox_items(spark: SparkSession, d: str) -> DataFrame:
    """Customers rendered as infoboxes; the last row only ends a box."""
    row = lambda a, b: F.concat(F.lit(f"<tr><th>{a}</th><td>"), b, F.lit("</td></tr>"))
    head = lambda a: F.lit(f"<tr><th colspan=2>{a}</th></tr>")
    box = F.concat(F.lit('<table class="infobox vcard">'), head("Account"), row("Name", F.col("c_name")), row("Nation", F.col("c_nationkey").cast("string")), head("Market"), row("Segment", F.col("c_mktsegment")), row("Last", F.lit("x")), F.lit("</table>"))
    return html.infoboxes(table(spark, d, "customer").withColumn("box", box), "c_custkey", "box")


@query(r"SELECT seq, len(regexp_extract_all(original_table_html, 'href=\"')) AS n_links FROM wiki_tables WHERE original_table_html IS NOT NULL")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "wiki_tables").where("original_table_html is not null")
    return w.withColumn("x", html.texts_and_links("original_table_html")).select("seq", F.size("x.urls").cast("bigint").alias("n_links"))


# Text

@query("SELECT seq, CASE " + " ".join(f"WHEN contains(lower(question), '{k}') THEN '{k}'" for k in text.AVOID_KEYWORDS) + " END AS keyword FROM qar_records")
def keyword_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qar_records").select("seq", text.first_keyword("question").alias("keyword"))


@query("SELECT seq FROM qar_records WHERE question_quality.complexity_rating >= 3 AND question_quality.self_containedness_rating >= 4 AND question_quality.naturalness_rating >= 4")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    q = "question_quality."
    return table(spark, d, "qar_records").where((F.col(q + "complexity_rating") >= 3) & (F.col(q + "self_containedness_rating") >= 4) & (F.col(q + "naturalness_rating") >= 4)).select("seq")


_TRACE = "'Corresponding code snippet:' || chr(10) || '```python' || chr(10) || python_code || chr(10) || '```' || chr(10) || chr(10) || chr(10) || 'Resulting intermediate variable:' || reasoning_traces || chr(10) || '**Purpose and action in natural language:**'"


def _traces(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("Corresponding code snippet:\n```python\n"), "python_code", F.lit("\n```\n\n\nResulting intermediate variable:"), "reasoning_traces", F.lit("\n**Purpose and action in natural language:**"))
    return table(spark, d, "qar_records").select("seq", t.alias("t"))


def _replaced(x: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', {b})"
    return x


@query("SELECT seq, trim(regexp_replace(" + _replaced(f"regexp_replace({_TRACE}, '(?s)```python.*?```', '', 'g')", [(a, "''") for a in text.STEP_ARTEFACTS] + [(p, "'The intermediate result is:' || chr(10)") for p in text.STEP_PHRASES]) + ", '\\n{3,}', chr(10) || chr(10), 'g')) AS trace FROM qar_records")
def clean_trace_steps(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).select("seq", text.clean_steps("t").alias("trace"))


_LINES = "array_to_string(list_transform(list_filter(string_split(regexp_replace({0}, '(?s)```python.*?```', '', 'g'), chr(10)), lambda x: NOT contains(lower(x), 'purpose and action in natural language') AND NOT contains(lower(x), 'corresponding code snippet')), lambda x: CASE WHEN contains(lower(x), 'intermediate variable') THEN 'The intermediate result is:' ELSE x END), chr(10))"


@query(f"SELECT seq, regexp_replace(regexp_replace({_LINES.format('coalesce(' + _TRACE + ', ' + chr(39) * 2 + ')')}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS trace FROM qar_records")
def clean_trace_lines(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).select("seq", text.clean_lines("t").alias("trace"))


@query("SELECT seq, CASE WHEN regexp_matches(sql_query, '(?s)```sql(.*?)```') THEN trim(regexp_extract(sql_query, '(?s)```sql\\s*(.*?)\\s*```', 1)) ELSE sql_query END AS sql FROM qar_records")
def fence_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qar_records").select("seq", text.fenced("sql_query", "sql").alias("sql"))


@query(r"""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_matches(trim(x), '^#') THEN replace(x, regexp_extract(trim(x), '^(#+)', 1),
    CASE length(regexp_extract(trim(x), '^(#+)', 1)) WHEN 1 THEN '**Document Title**: ' WHEN 2 THEN '*Section*: ' ELSE '*Sub' || repeat('sub', length(regexp_extract(trim(x), '^(#+)', 1)) - 3) || 'section*: ' END) ELSE x END), chr(10)) AS text FROM documents""")
def heading_neutralise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.neutral_headings("text").alias("text"))


@query(r"SELECT doc_id, regexp_extract(text, '(?is)#+\s*bridge\s*(.*?)(?:\n#|\z)', 1) AS section FROM documents WHERE regexp_matches(text, '(?is)#+\s*bridge')")
def section_by_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.section_of("text", "Bridge").alias("section")).where("section is not null")


@query("SELECT n_nationkey, n_name || ' lies in region ' || n_regionkey || ', {unknown}' AS filled FROM nation")
def placeholder_fill(spark: SparkSession, d: str) -> DataFrame:
    m = F.create_map(F.lit("name"), "n_name", F.lit("region"), F.col("n_regionkey").cast("string"))
    return table(spark, d, "nation").select("n_nationkey", text.fill(F.lit("{name} lies in region {region}, {unknown}"), m).alias("filled"))


@query(r"SELECT seq, string_agg('**Document ' || (i + 1) || '**:' || chr(10) || regexp_replace(regexp_replace(relevant_web_articles[i + 1], '[\n ]+', ' ', 'g'), '<[^>]+>', '', 'g'), chr(10) || chr(10) ORDER BY i) AS docs FROM (SELECT seq, relevant_web_articles, unnest(range(len(relevant_web_articles))) AS i FROM websearch) GROUP BY seq")
def doc_set_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "websearch").where(F.size("relevant_web_articles") > 0).select("seq", text.document_list("relevant_web_articles").alias("docs"))


@query("""SELECT seq, 'user: ' || 'Given the following documents:' || chr(10) || chr(10) || '' || chr(10) || chr(10) || 'Question: ' || question || chr(10) || '(Please answer within the scope of the given documents.)' || CASE WHEN coalesce(llm_generated_reasoning_traces, '') <> '' THEN chr(10) || 'assistant: ' || llm_generated_reasoning_traces ELSE '' END AS chat FROM attempts WHERE question IS NOT NULL""")
def chat_messages(spark: SparkSession, d: str) -> DataFrame:
    m = text.messages(text.narrate(F.lit(""), F.col("question")), "llm_generated_reasoning_traces")
    return table(spark, d, "attempts").where("question is not null").select("seq", F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(": "), x["content"])), "\n").alias("chat"))


_LETTERS = r"regexp_replace({0}, '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _put_together(chunks: DataFrame, key: str) -> DataFrame:
    """The letters and digits of a text's chunks in order."""
    g = chunks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "chunk"))), lambda x: x["chunk"]), "").alias("t"))
    return g.select(key, F.regexp_replace("t", r"[^\p{L}\p{N}]+", "").alias("letters"))


@query(f"SELECT doc_id, {_LETTERS.format('text')} AS letters FROM documents WHERE regexp_matches(text, '\\S')")
def sentence_pack_text(spark: SparkSession, d: str) -> DataFrame:
    """Nothing is lost or moved by packing sentences."""
    return _put_together(sentence_pack(spark, d), "doc_id")


@query(f"SELECT sample_id, {_LETTERS.format('context')} AS letters FROM merged_samples WHERE context IS NOT NULL")
def markdown_chunks_text(spark: SparkSession, d: str) -> DataFrame:
    """Nothing is lost or moved by chunking markdown."""
    return _put_together(markdown_chunks(spark, d), "sample_id")


_REQUIRED = ["table_id", "question", "df", "sql_query", "final_answer_sql", "reasoning_traces"]


@query("SELECT seq, CASE " + " ".join(f"WHEN coalesce({f}, '') = '' THEN '{f}'" for f in _REQUIRED) + " END AS missing FROM qar_records")
def required_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qar_records").select("seq", text.first_missing(_REQUIRED).alias("missing"))


@query("""SELECT seq, md5('Given the following documents:' || chr(10) || chr(10) || df || chr(10) || chr(10) || 'Question: ' || question || chr(10) || '(Please answer within the scope of the given documents.)') AS input,
    md5('To answer this question, I first aggregate the key information from the documents into a structured table:' || chr(10) || chr(10) || df || chr(10) || chr(10) || 'Now I''ll work through the solution step by step:' || chr(10) || chr(10) || reasoning_traces) AS thinking,
    md5('Based on the analysis, the answer is:' || chr(10) || chr(10) || coalesce(final_answer_sql, 'None')) AS output FROM qar_records""")
def narrated_samples(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "qar_records")
    return q.select("seq", F.md5(text.narrate("df", "question")).alias("input"), F.md5(text.thinking("df", "reasoning_traces")).alias("thinking"), F.md5(text.output("final_answer_sql")).alias("output"))


@query("SELECT sample_id, table_id, question, final_answer_sql, len(relevant_web_urls) AS n_urls, df_md AS context FROM merged_samples")
def attempt_inputs(spark: SparkSession, d: str) -> DataFrame:
    a = generation.attempt_inputs(table(spark, d, "merged_samples"), from_table=True)
    return a.select("sample_id", "table_id", "question", "final_answer_sql", F.when(F.col("relevant_web_urls").isNotNull(), F.size("relevant_web_urls").cast("bigint")).alias("n_urls"), "context")


@query("""SELECT r_regionkey, r_name || ' has ' || '[' || chr(10) || '  "' || string_agg(n_name, '",' || chr(10) || '  "' ORDER BY n_name) || '"' || chr(10) || ']' AS filled, '{r} has {names} and {more}' AS raw
    FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name""")
def trace_values(spark: SparkSession, d: str) -> DataFrame:
    """A whole trace with a text and a list put in, and one with a placeholder that has no value."""
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    j = table(spark, d, "region").join(n, F.col("n_regionkey") == F.col("r_regionkey"))
    values = F.create_map(F.lit("r"), "r_name", F.lit("names"), text.json_text("names"))
    return j.select("r_regionkey", text.fill_all(F.lit("{r} has {names}"), values).alias("filled"), text.fill_all(F.lit("{r} has {names} and {more}"), values).alias("raw"))


@query()
def bpe_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of a public vocabulary in traces and whole messages."""
    a = table(spark, d, "attempts")
    n = tokens.byte_pairs(VOCABULARY)
    return a.select("seq", n("llm_generated_reasoning_traces").alias("trace_tokens"), tokens.message_tokens(["question", "final_answer_sql", "llm_generated_reasoning_traces"], VOCABULARY).alias("message_tokens"))


@query()
def sentence_pack(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(chunk.chunks("text", chunk.sentence_chunks, 60)).alias("i", "chunk"))


@query()
def markdown_chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "merged_samples").select("sample_id", F.posexplode(chunk.chunks("context", chunk.markdown_chunks, 256)).alias("i", "chunk"))


@query("SELECT sample_id, context FROM merged_samples WHERE context IS NOT NULL")
def recursive_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks put together again, so that every chunk is held against its source."""
    return table(spark, d, "merged_samples").where("context is not null").select("sample_id", F.array_join(chunk.chunks("context", chunk.recursive_chunks), "").alias("context"))


# Ad-hoc queries

@query()
def own_sql_answers(spark: SparkSession, d: str) -> DataFrame:
    return adhoc.run_own_sql(table(spark, d, "qar_records"), "seq")


_NORM = r"regexp_replace(regexp_replace(lower(trim(regexp_replace({0}, '\s+', ' ', 'g'))), ' ?\.$', ''), '(\d),(\d{{3}})', '\1\2', 'g')"


_SAME = "CASE WHEN {0} IS NULL OR {1} IS NULL THEN NULL ELSE coalesce({2} = {3}, false) OR coalesce(abs(TRY_CAST({2} AS DOUBLE) - TRY_CAST({3} AS DOUBLE)) <= 1e-6 * greatest(abs(TRY_CAST({2} AS DOUBLE)), abs(TRY_CAST({3} AS DOUBLE)), 1), false) END"


def _same(a: str, b: str) -> str:
    return _SAME.format(a, b, _NORM.format(a), _NORM.format(b))


@query(f"""SELECT seq, {_same("final_answer_sql", "final_answer_python")} AS same, {_same("final_answer_sql", "upper(final_answer_sql) || ' .'")} AS spaced, {_same("final_answer_sql", "upper(final_answer_sql) || '.'")} AS dotted,
    CASE WHEN df IS NOT NULL THEN true END AS grouped, {_same("(len(df) + 0.5)::varchar", "(len(df) + 0.25)::varchar")} AS apart FROM qar_records""")
def answer_equivalence(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "qar_records").select("seq", "final_answer_sql", "final_answer_python", F.char_length("df").alias("n"))
    q = q.withColumns({"up": F.concat(F.upper("final_answer_sql"), F.lit(" .")), "dot": F.concat(F.upper("final_answer_sql"), F.lit(".")), "big": F.format_number(F.col("n") * 1000.0, 3), "plain": (F.col("n") * 1000).cast("string"), "half": (F.col("n") + 0.5).cast("string"), "quarter": (F.col("n") + 0.25).cast("string")})
    s = adhoc.same_answer
    return q.select("seq", s("final_answer_sql", "final_answer_python").alias("same"), s("final_answer_sql", "up").alias("spaced"), s("final_answer_sql", "dot").alias("dotted"), s("big", "plain").alias("grouped"), s("half", "quarter").alias("apart"))


@query("SELECT n_name FROM nation WHERE n_regionkey = 3")
def sql_filter_eq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").where("n_regionkey = 3").select("n_name")


@query("SELECT n_name, round(avg(c_acctbal), 6) AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY mean DESC LIMIT 1")
def sql_avg_group_top1(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.avg("c_acctbal"), 6).alias("mean")).orderBy(F.desc("mean")).limit(1)


@query("SELECT c_mktsegment, round(avg(CAST(replace(t, ',', '') AS DOUBLE)), 4) AS mean FROM (SELECT c_mktsegment, format('{:,.2f}', c_acctbal) AS t FROM customer) GROUP BY c_mktsegment")
def sql_clean_cast_avg(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "customer").select("c_mktsegment", F.format_number("c_acctbal", 2).alias("t"))
    return t.groupBy("c_mktsegment").agg(F.round(F.avg(F.replace("t", F.lit(","), F.lit("")).cast("double")), 4).alias("mean"))


@query("SELECT p_partkey, p_brand, p_retailprice FROM part a WHERE p_retailprice = (SELECT min(p_retailprice) FROM part b WHERE b.p_brand = a.p_brand)")
def sql_correlated_min(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    m = p.groupBy("p_brand").agg(F.min("p_retailprice").alias("p_retailprice"))
    return p.join(m, ["p_brand", "p_retailprice"]).select("p_partkey", "p_brand", "p_retailprice")


@query("SELECT p_type, n FROM (SELECT p_type, count(*) AS n FROM part GROUP BY p_type) WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_type))")
def value_counts_mode(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return g.join(g.agg(F.max("n").alias("n")), "n").select("p_type", "n")


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < (SELECT max(m) FROM (SELECT avg(s_acctbal) AS m FROM supplier GROUP BY s_nationkey))")
def below_avg_of_best_group(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    best = s.groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("m")).agg(F.max("m").alias("m")).first()["m"]
    return s.where(F.col("s_acctbal") < F.lit(best)).select("s_suppkey", "s_acctbal")


@query(r"""SELECT seq, trim(regexp_extract(t, '(?s)\[\[ ## question ## \]\]\s*(.*?)\s*(?:\[\[ ## |\z)', 1)) AS question, TRY_CAST(regexp_extract(t, '(?s)\[\[ ## rating ## \]\]\s*(.*?)\s*(?:\[\[ ## |\z)', 1) AS INTEGER) AS rating
    FROM (SELECT seq, '[[ ## question ## ]]' || chr(10) || question || chr(10) || '[[ ## rating ## ]]' || chr(10) || question_quality.complexity_rating || chr(10) || '[[ ## completed ## ]]' AS t FROM qar_records WHERE question IS NOT NULL AND question_quality.complexity_rating IS NOT NULL)""")
def reply_sections(spark: SparkSession, d: str) -> DataFrame:
    """Replies with one malformed marker each, read by section."""
    q = table(spark, d, "qar_records").where("question is not null and question_quality.complexity_rating is not null")
    t = F.concat(F.lit("[[## question ## ]]\n"), "question", F.lit("\n[[ ## rating ##]]\n"), F.col("question_quality.complexity_rating").cast("string"), F.lit("\n[[ ## completed ## ]]"))
    return q.withColumn("_t", t).select("seq", F.trim(generation.section("_t", "question")).alias("question"), generation.section("_t", "rating", "int").alias("rating"))


@query("SELECT q.seq, coalesce(w.new_columns[1], '(No condition column)') AS condition_col FROM qar_records q JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY seq DESC) AS r FROM wiki_tables) WHERE r = 1) w USING (table_id)")
def first_new_column(spark: SparkSession, d: str) -> DataFrame:
    w = windows.last_wins(table(spark, d, "wiki_tables").select("table_id", "seq", "new_columns"), ["table_id"], ["seq"])
    return table(spark, d, "qar_records").select("seq", "table_id").join(w.drop("seq"), "table_id").select("seq", F.coalesce(F.get("new_columns", F.lit(0)), F.lit("(No condition column)")).alias("condition_col"))


@query("SELECT seq, string_split(table_metadata.section_title, ' / ')[-1] AS last_part FROM wiki_tables WHERE table_metadata.section_title IS NOT NULL")
def section_last_part(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wiki_tables").where("table_metadata.section_title is not null").select("seq", text.last_path_part("table_metadata.section_title").alias("last_part"))


@query("""SELECT basename, CASE WHEN contains(substr(page_text, 1, 10000), chr(10) || chr(10)) THEN string_split(substr(page_text, 1, 10000), chr(10) || chr(10))[1] ELSE substr(page_text, 1, 10000) END AS lead FROM articles""")
def page_leads(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("basename", text.must_keep("page_text").alias("lead"))


@query("SELECT setting, attempt_no, count(*) AS n FROM (SELECT setting, attempt_no FROM attempts WHERE setting LIKE 'md%' UNION ALL SELECT setting, attempt_no FROM attempts WHERE setting LIKE 'ctx%') GROUP BY ALL")
def union_of_settings(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "attempts").select("setting", "attempt_no")
    return a.where("setting like 'md%'").unionByName(a.where("setting like 'ctx%'")).groupBy("setting", "attempt_no").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT page_metadata.page_title AS title FROM wiki_tables")
def shuffled_titles(spark: SparkSession, d: str) -> DataFrame:
    return generation.shuffled(table(spark, d, "wiki_tables").select(F.col("page_metadata.page_title").alias("title")).distinct(), "title")


@query()
def table_answers(spark: SparkSession, d: str) -> DataFrame:
    return cells.simplified(cells.from_markdown(table(spark, d, "merged_samples").where("final_answer_sql like '|%'"), "sample_id", "final_answer_sql"), "sample_id")


@query()
def article_markdown(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wiki_tables").select("seq", html.markdown_of("original_table_html").alias("markdown"))
