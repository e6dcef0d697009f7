import re
import random
import sqlite3
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tesserae.functions import chunk, text
from tesserae.operators import adhoc, aggregates, cells, joins, retrieval, windows
from tesserae.plans import context, pages
from tesserae.sources import clients, files, html

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_budget_prefix_is_the_loop(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.randint(0, 9)) for g in range(20) for i in range(rng.randint(1, 15))]
    want = set()
    for g in range(20):
        left = 25
        for k, i, n in sorted(rows):
            if k == g:
                if n > left:
                    break
                left -= n
                want.add((g, i))
    df = spark.createDataFrame(rows, "g int, i int, n int")
    assert {(r.g, r.i) for r in windows.budget_prefix(df, ["g"], ["i"], "n", 25).collect()} == want


def test_slices_partition_the_input(spark):
    for n, parts in ((0, 3), (1, 3), (10, 3), (23, 7)):
        got = windows.slices(spark.range(n).withColumn("x", -F.col("id")), "id", parts, buckets=5).collect()
        want = {i: next(k for k in range(1, parts + 1) if (k - 1) * n // parts <= i < k * n // parts) for i in range(n)}
        assert {r.id: r.slice for r in got} == want and {r.ordinal for r in got} == set(range(n))


def test_last_wins_and_resume(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), (None, 4, "z")], "k string, seq int, v string")
    assert sorted(map(tuple, windows.last_wins(df, ["k"], ["seq"]).collect()), key=str) == sorted([("a", 3, None), ("b", 2, "y"), (None, 4, "z")], key=str)
    assert [r.seq for r in windows.resume_after(df, df.where("seq = 2"), "k", "seq").orderBy("seq").collect()] == [3, 4]
    assert windows.resume_after(df, df.limit(0), "k", "seq").count() == 4


def test_match_rates(spark):
    rows = [("f", False)] * 3 + [("e", True)] * 9 + [("e", None)] + [("h", True)] * 4 + [("h", False)]
    got = {r.q: (r.total, r.matches, r.bucket, r.kept) for r in aggregates.match_rates(spark.createDataFrame(rows, "q string, ok boolean"), "q", "ok").collect()}
    assert got == {"f": (3, 0, "failed", False), "e": (10, 9, "easy", False), "h": (5, 4, "hard", True)}


def test_href_titles(spark):
    rows = [("/wiki/A_b%20c#x",), ("/wiki/File:x",), ("/wiki/a+b",), ("/wiki/%zz",), ("/w/x",), ("/wiki/#x",), ("/wiki/a%23b",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").select(text.href_to_title("h")).collect()]
    assert got == ["A b c", None, "a+b", "%zz", None, None, "a", None]


def test_text_expressions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.first_keyword(F.lit("Which listener grew?"))) == "list"
    assert one(text.repair_markers(F.lit("[[## a ##]]"))) == "[[ ## a ## ]]"
    assert one(text.neutral_headings(F.lit("# T\n### S # x\ntext # y"))) == "**Document Title**:  T\n*Subsection*:  S # x\ntext # y"  # the marker's name ends in a blank of its own
    assert one(text.neutral_headings(F.lit("#### Deep"))) == "*Subsubsection*:  Deep"
    assert one(text.clean_lines(F.lit("a\n```python\nx\n```\n**Corresponding code snippet:**\n\n\n\nResulting intermediate variable: y\n"))) == "a\n\nThe intermediate result is:" and one(text.clean_lines(F.lit(None).cast("string"))) == ""
    values = F.create_map(F.lit("a"), F.lit("1"))
    assert one(text.fill_all(F.lit("{a} and"), values)) == "1 and" and one(text.fill_all(F.lit("{a} {b}"), values)) == "{a} {b}" and one(text.fill_all(F.lit("{a} }"), values)) == "{a} }"
    assert one(text.json_text(F.array(F.lit('x"y'), F.lit("z")))) == '[\n  "x\\"y",\n  "z"\n]' and one(text.json_text(F.struct(F.lit("u").alias("k"), F.lit(2).alias("n")), ["k", "n"])) == '{\n  "k": "u",\n  "n": 2\n}'
    assert one(text.section_of(F.lit("# A\n## Brid ge\nbody\nmore\n# C"), "brid")) == "ge\nbody\nmore"
    assert one(text.clean_steps(F.lit("x\n```python\ncode\n```\nCorresponding code snippet:\n\n\n\ny"))) == "x\n\ny"
    assert one(text.clean_lines(F.lit("a\n**Corresponding code snippet**:\nIntermediate variable: 3\nb"))) == "a\nThe intermediate result is:\nb"
    assert tuple(one(text.split_around(F.lit("abcXYdef"), F.lit("XY")))) == ("abc", "def")
    assert one(text.fenced(F.lit("say ```sql\nSELECT 1\n``` ok"), "sql")) == "SELECT 1"
    assert one(text.must_keep(F.lit("lead\n\nrest"))) == "lead"


def test_html_grid_spans_and_names(spark):
    page = "<table><tr><th colspan=2>Top</th></tr><tr><th>A[1]</th><th>B</th></tr><tr><td rowspan=2><a href='/wiki/X'>x</a>[2]</td><td>1<br>2</td></tr><tr><td>[3]</td></tr></table>"
    levels, names, body = html.shaped(*html.grid_of(html.parse(page).all("table")[0]))
    assert levels == ["Top"] and names == ["A", "B"]
    assert body == [[("x", "/wiki/X"), ("1; 2", None)], [("x", "/wiki/X"), ("[3]", None)]]


def test_page_tables_context(spark):
    page = "<h2>One</h2><div class=hatnote>See <a href='/wiki/Y'>Y</a></div><table class='wikitable'><caption>Cap</caption><tr><th>A</th></tr><tr><td>1</td></tr></table><h3>Two</h3><table class='navbox'><tr><td>x</td></tr></table><table class=infobox><tr><td>y</td></tr></table>"
    got = html.page_tables(spark.createDataFrame([(7, page), (8, None), (9, "")], "page_id bigint, html string")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.route, r.section) for r in got] == [(1, "table", "One"), (2, "skip", "One / Two"), (3, "infobox", "One / Two")]
    assert got[0].caption == "Cap" and got[0].hatnote == "See Y" and got[0].hatnote_urls == ["/wiki/Y"] and got[0].cells[0].text == "1"


def test_infobox_sections_and_lost_row():
    box = html.parse("<table class=infobox><tr><td>img</td></tr><tr><th>S</th></tr><tr><th>a</th><td>1</td></tr><tr><th>a</th><td>2</td></tr><tr><th>z</th><td>9</td></tr></table>").all("table")[0]
    assert html.infobox_rows(box) == [("General", 0, None, "img"), ("S", 0, "a", "2")]
    assert ("S", 1, "z", "9") in html.infobox_rows(box, lose_last=False)


def test_markdown_and_main_text():
    page = "<nav>menu</nav><h1>T</h1><p>Hello <a href=x>you</a><script>no</script></p><ul><li>a</li></ul><img alt=pic><footer>f</footer>"
    assert html.to_markdown(html.parse(page), main_only=True) == "# T\n\nHello you\n\n- a\n\n![pic](image)"


def test_markdown_cells_roundtrip(spark):
    df = spark.createDataFrame([(1, "| | A | B |\n|---|---|---|\n| 0 | x | |\n| 1 | y | 2 |"), (2, "one line"), (3, None)], "k int, md string")
    c = cells.from_markdown(df, "k", "md")
    assert sorted(map(tuple, c.collect())) == [(1, 0, 0, "A", "x"), (1, 0, 1, "B", None), (1, 1, 0, "A", "y"), (1, 1, 1, "B", "2")]
    assert cells.to_markdown(c, "k").first().markdown == "| A | B |\n| --- | --- |\n| x |  |\n| y | 2 |"


def test_unfold_drops_incomplete_groups(spark):
    rows = [("t", 0, j, n, v) for j, (n, v) in enumerate([("a", "1"), ("b", "2"), ("a.1", "3"), ("b.1", "4"), ("a.2", "5")])]
    got = cells.unfold(spark.createDataFrame(rows, "t string, row_idx int, col_idx int, col_name string, text string"), "t").select("row_idx", "col_idx", "text").collect()
    assert sorted(map(tuple, got)) == [(0, 0, "1"), (0, 1, "2"), (1, 0, "3"), (1, 1, "4")]


def test_gate_types_and_empty_rows(spark):
    rows = [(1, i, j, f"c{j}", t) for i, r in enumerate([["1", "a"], [None, None], ["2.5e3", "7d"]]) for j, t in enumerate(r)]
    df = spark.createDataFrame(rows, "k int, row_idx int, col_idx int, col_name string, text string")
    assert {r.col_name: r.inferred for r in cells.column_types(df, "k").collect()} == {"c0": "numeric", "c1": "text"}
    assert not cells.gate(df, "k").first().regular and cells.gate(cells.drop_empty(df, "k"), "k").first().regular


def test_validation_reasons(spark):
    schema = "k int, row_idx int, col_idx int, col_name string, text string"
    make = lambda k, cols: [(k, i, j, n, v) for j, (n, vs) in enumerate(cols) for i, v in enumerate(vs)]
    base = [("A", ["p", "q"])]
    cases = {1: [("N", ["red, blue", "green"])], 2: [("N", ["x", "x"])], 3: [("N", ["red", "green"]), ("M", ["green", "red"])], 4: [("N", ["red", "nowhere"])], 5: [("N", ["red", "green"]), ("N", ["red", "blue"])]}
    orig = spark.createDataFrame([r for k in cases for r in make(k, base)], schema)
    exp = spark.createDataFrame([r for k, v in cases.items() for r in make(k, base + v)], schema)
    summ = spark.createDataFrame([(k, i, "Red and blue and Green") for k in cases for i in range(2)], "k int, row_idx int, summary string")
    got = {r.k: r.verdict for r in cells.validate_expansion(orig, exp, summ, "k").collect()}
    assert got == {1: "ok", 2: "no_new_column", 3: "duplicate_column", 4: "not_in_summary", 5: "repeated_name"}


def test_simplified(spark):
    schema = "k int, row_idx int, col_idx int, col_name string, text string"
    got = {r.k: (r.answer_kind, r.answer) for r in cells.simplified(spark.createDataFrame([(1, 0, 0, "a", "x"), (2, 0, 0, "a", "x"), (2, 1, 0, "a", "y"), (3, 0, 0, "a", "x"), (3, 0, 1, "b", None)], schema), "k").collect()}
    assert got == {1: ("value", "x"), 2: ("list", "['x', 'y']"), 3: ("pairs", "{'a': 'x', 'b': ''}")}


def test_chunkers():
    t = "para one. It goes on.\n\npara two " + "x" * 50 + "\nline. end"
    for limit in (5, 12, 30, 200):
        got = chunk.recursive_chunks(t, limit)
        assert "".join(got) == t
    assert chunk.sentence_chunks("A b. C d e. F.", 3) == ["A b.", "C d e.", "F."]
    md = "intro text here\n| a | b |\n| 1 | 2 |\nafter\n```\ncode\n```\ntail"
    assert chunk.markdown_chunks(md, 3) == ["intro text here", "| a | b |\n| 1 | 2 |", "after", "```\ncode\n```", "tail"]
    assert chunk.markdown_chunks("", 3) == [""]


def test_bm25_prefers_the_match_and_packs(spark):
    docs = spark.createDataFrame([(1, "cats and dogs like cats"), (2, "birds sing songs"), (3, None), (4, "")], "chunk_id int, text string")
    q = spark.createDataFrame([(9, "Tell me about cats and dogs.")], "query_id int, text string")
    s = retrieval.bm25(docs, q)
    assert [r.chunk_id for r in s.collect()] == [1]
    assert retrieval.within_budget(s, 4).count() == 0 and retrieval.within_budget(s, 5).count() == 1
    parts = spark.createDataFrame([(9, 0, 0, "cats purr"), (9, 0, 1, "filler words here"), (9, 1, 0, "nothing else"), (8, 0, 0, "a small one")], "query_id int, doc_order int, chunk_order int, text string")
    got = {(r.query_id, r.doc_order): r.body for r in retrieval.compact(parts, spark.createDataFrame([(9, "cats"), (8, "x")], "query_id int, text string"), 3).collect()}
    assert got == {(9, 0): "cats purr", (9, 1): "", (8, 0): "a small one"}


CLUBS = "| club | sport | founded | venue |\n|---|---|---|---|\n| A | football | 1914 | K |\n| B | football | 1924 | K |\n| C | handball | 1948 | S |"


def test_own_sql_and_limits(spark):
    assert adhoc.query_table(CLUBS, '```sql\nSELECT "venue", COUNT(*) FROM df WHERE "sport" = \'football\' GROUP BY 1\n```') == ("ok", 1, 2, "K | 2")
    assert adhoc.query_table(CLUBS, "SELECT club FROM df d1 WHERE founded = (SELECT MIN(founded) FROM df d2 WHERE d1.venue = d2.venue) ORDER BY 1")[3] == "A\nC"
    assert adhoc.query_table(CLUBS, "ATTACH 'x.db' AS y")[0] == "error" and adhoc.query_table(CLUBS, "SELECT 1 FROM nope")[0] == "error"
    loop = "WITH RECURSIVE c(x) AS (SELECT 1 UNION ALL SELECT x + 1 FROM c) SELECT max(x) FROM c"
    assert adhoc.query_table(CLUBS, loop)[0] == "error"
    assert adhoc.query_table("", "SELECT 1")[0] == "error" and sqlite3.sqlite_version
    df = spark.createDataFrame([(1, CLUBS, "SELECT count(*) FROM df"), (2, None, "x"), (3, CLUBS, None)], "seq int, df string, sql_query string")
    assert {r.seq: (r.state, r.answer) for r in adhoc.run_own_sql(df, "seq").collect()} == {1: ("ok", "3"), 2: (None, None), 3: (None, None)}


def test_spark_sql_over_cells_and_comparison(spark):
    c = cells.from_markdown(spark.createDataFrame([("t", CLUBS)], "k string, md string"), "k", "md")
    a = adhoc.run_sql(spark, c, "k", "t", 'SELECT "venue", avg("founded") AS m FROM df WHERE "club" LIKE \'%\' GROUP BY "venue"')
    b = adhoc.run_own_code(adhoc.wide(c, "k", "t"), lambda d: d.groupBy("venue").agg(F.avg("founded").alias("m")))
    assert adhoc.same_rows(a, b) and not adhoc.same_rows(a, b.where("venue = 'K'"))
    rows = [("1,234.0", "1234"), ("A b.", "a  B"), ("x", "y"), (None, "x"), ("0.1", "0.1000000001")]
    assert [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(adhoc.same_answer("a", "b")).collect()] == [True, True, False, None, True]


def test_joins_footnotes_and_fixes(spark):
    c = spark.createDataFrame([("t1", 1, "#n2"), ("t1", 1, "#n1"), ("t1", 1, "#n2"), ("t2", 1, "#zz"), ("t2", 1, None)], "table_id string, page_id int, href string")
    refs = spark.createDataFrame([(1, "n1", "one"), (1, "n2", "two")], "page_id int, ref_id string, text string")
    assert [(r.table_id, r.notes) for r in joins.footnotes(c, refs).collect()] == [("t1", ["one", "two"])]
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sorted(map(tuple, joins.fixed(base, spark.createDataFrame([(2, "B")], "id int, v string"), "id", ["v"]).collect())) == [(1, "a"), (2, "B")]


def test_context_budget_is_seeded(spark):
    df = spark.createDataFrame([(1, 3), (2, 0)], "i int, n int").select(context.budget_and_order("i", "n").alias("x"))
    g = random.Random(1)
    b = int(1024 * (g.normalvariate(54, 30) + 9))
    order = [0, 1, 2]
    g.shuffle(order)
    got = [r.x for r in df.collect()]
    assert got[0].budget == min(max(b, 4096), 98304) and got[0].order == order and got[1].order == []


def test_contexts_fill_their_own_budget(spark):
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    page = words("lead", 300) + "\n\n" + "\n\n".join(f"mill {words(f'p{k}x', 40)}." for k in range(160))
    arts = spark.createDataFrame([("a", "A", page), ("b", "B", page)], "basename string, title string, page_text string")
    qs = spark.createDataFrame([(i, "mill", ["a", "b"]) for i in range(12)], "sample_id int, question string, relevant_web_articles array<string>")
    size = lambda t: len(re.findall(r"\w{2,}", t))
    got = context.pack_contexts(qs, arts, chunk_words=64).collect()
    assert len(got) == 12 and len({r.budget for r in got}) > 5
    for r in got:
        assert ("p159x39" in r.context and "p0x0" in r.context) or r.budget < 13800
    cut = [r for r in context.pack_contexts(qs, arts, budget=5000, chunk_words=64).collect() if size(r.context) <= 5000 + 10]
    assert len(cut) == 12 and all(size(r.context) > 4000 and "lead299" in r.context for r in cut)


def test_files_roundtrip(spark, tmp_path):
    p = str(tmp_path / "x.jsonl")
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{}\n{"a": 2, "b": "ü"}\n')
    good, bad = files.read_jsonl_tolerant(spark, p, "a int, b string")
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, None), (2, "ü")] and [r.line for r in bad.collect()] == ["not json"]
    out = str(tmp_path / "out")
    files.write_jsonl(good, out)
    assert files.verify_written(good, out)
    (tmp_path / "t.txt").write_text("# 2014\nA b\n\nC\n# 2015\nD\n")
    assert [(r.year, r.title) for r in files.read_titles_by_year(spark, str(tmp_path / "t.txt")).orderBy("seq").collect()] == [(2014, "A b"), (2014, "C"), (2015, "D")]
    blocks = files.grouped_titles(files.read_titles_by_year(spark, str(tmp_path / "t.txt"))).orderBy("year").collect()
    assert blocks[0].block == "# 2014\nA b\nC"
    (tmp_path / "p.txt").write_text("<table></table>#-----#\n#-----#<p>x</p>")
    assert files.read_pieces(spark, str(tmp_path / "p.txt")).count() == 2
    (tmp_path / "md_3.jsonl").write_text('{"a": 5}\n')
    r = files.read_attempts(spark, str(tmp_path / "md_*.jsonl"), "a int").first()
    assert (r.setting, r.attempt_no, r.a) == ("md", 3, 5)


def test_clients(spark):
    calls = []
    assert clients.with_retries(lambda: calls.append(1) or None) is None and len(calls) == 3
    df = spark.createDataFrame([(1, "hi"), (2, None)], "id int, p string")
    got = {r.id: r.completion for r in clients.complete_all(df, "id", "p", clients.StubModel).collect()}
    assert got[1].startswith("stub-") and got[2] is None
    keys = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "k string")
    cache = spark.createDataFrame([("c", "old")], "k string, text string")
    assert [tuple(r) for r in clients.fetch_missing(keys, cache, "k", lambda: clients.StubPages({"a": "A", "b": ""})).collect()] == [("a", "A")]
    assert len(clients.first_provider([clients.StubSearch()], "q", 3)) == 3


def test_ingest_resumes(spark, tmp_path):
    from tesserae.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"k": 1}\n{"k": 1}\n')
    go = lambda: ingest(spark, str(tmp_path / "in"), "k int", str(tmp_path / "out"), str(tmp_path / "cp"), key="k")
    go()
    (tmp_path / "in" / "2.json").write_text('{"k": 1}\n{"k": 2}\n')
    go()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


@pytest.mark.parametrize("name", ["table_gate", "bm25_per_question", "merge_last_wins", "own_sql_answers"])
def test_catalogue_runs(spark, name):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    from tesserae.plans.catalogue import queries

    assert queries()[name](spark, d).count() > 0


class Echo:
    """Replies with the sections that a prompt wants; attempt 2 answers right."""

    def complete(self, messages):
        m = messages[-1]["content"]
        if "fail" in m:
            return None
        right = "[[ ## attempt_no ## ]]\n2" in m
        return f"[[ ## reasoning ## ]]\nbecause\n[[## answer ##]]\n{'1,000' if right else 'x'}\n[[ ## table ## ]]\n<table><tr><td>1</td></tr></table>\n[[ ## complexity_rating ## ]]\nfour\n[[ ## completed ## ]]"


def test_generation_stages(spark):
    from tesserae.plans import generation

    s = spark.createDataFrame([(1, "ctx", "q?", "1000"), (2, "ctx", "fail", "y")], "sample_id int, context string, question string, final_answer_sql string")
    got = {(r.sample_id, r.setting, r.attempt_no): r.answer_comparison for r in generation.sample_attempts(s, "sample_id", ["low", "high"], 3, Echo).collect()}
    assert len(got) == 12 and {k for k, v in got.items() if v} == {(1, "low", 2), (1, "high", 2)}
    assert [(r.sample_id, r.reasoning_traces) for r in generation.generate_traces(s, "sample_id", Echo).collect()] == [(1, "because")]
    t = spark.createDataFrame([("a", "h"), ("b", "h")], "table_id string, html string")
    summ = spark.createDataFrame([("a", 0, "T", "good"), ("b", 0, "T", "fail")], "table_id string, row_idx int, title string, summary string")
    assert {r.table_id: r.expanded_table_html[:6] for r in generation.expand_tables(t, summ, Echo).collect()} == {"a": "<table", "b": ""}
    trials = generation.question_trials(spark.createDataFrame([("a", "|x|")], "table_id string, df string"), Echo)
    assert trials.count() == 3 and trials.where(generation.passes_gate()).count() == 0


class Listing:
    def page(self, category, token):
        pages = {None: (["R/1", "other", "R/2"], "n"), "n": (["R/2", "R/3"], None)}
        return pages[token]


def test_listing_and_search(spark):
    got = clients.category_titles(spark.createDataFrame([("c",), ("c",)], "category string"), Listing, "R/").orderBy("pos").collect()
    assert [(r.pos, r.title) for r in got] == [(0, "R/1"), (1, "R/2"), (2, "R/3")]
    q = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "question string")
    cache = spark.createDataFrame([("b", ["u"])], "question string, urls array<string>")
    assert [(r.question, len(r.urls)) for r in clients.search_missing(q, cache, lambda: [clients.StubSearch()], 2).collect()] == [("a", 2)]


def test_markdown_chunks_keep_their_limit():
    text_ = "\n".join("one two three four five six seven eight" for _ in range(500))
    assert {len(x.split()) for x in chunk.markdown_chunks(text_, 64)} == {64, 32} and " ".join(" ".join(chunk.markdown_chunks(text_, 64)).split()) == " ".join(text_.split())
    md = "intro line\n| a | b |\n| 1 | 2 |\nafter\n```\ncode\n\nmore\n```\nend"
    assert chunk.markdown_chunks(md, 3) == ["intro line", "| a | b |\n| 1 | 2 |", "after", "```\ncode\nmore\n```", "end"]
    assert chunk.markdown_chunks(" \n ", 3) == [""] and chunk.sentence_chunks("A b. C d e. F.", 3) == ["A b.", "C d e.", "F."]


def test_every_chunk_is_ranked(spark):
    c = spark.createDataFrame([(1, 0, i, t) for i, t in enumerate(["red mill", "old tower", "blue mill", "last word here"])], "query_id int, doc_order int, chunk_order int, text string")
    cut = lambda n, q="mill": retrieval.compact(c, spark.createDataFrame([(1, q)], "query_id int, text string"), n).first().body
    assert cut(9) == "red mill\nold tower\nblue mill\nlast word here"
    assert cut(6) == "red mill...\nold tower...\nblue mill" and cut(4) == "red mill...\nblue mill" and cut(0) == "" and cut(2, "none") == "red mill"


def test_contexts_charge_what_they_keep(spark):
    page = "lead words stand here\n\nthe mill was red\n\nthe tower was old"
    q = spark.createDataFrame([(7, "which mill", ["a", "b", "zz"], 17)], "sample_id bigint, question string, relevant_web_articles array<string>, own int")
    a = spark.createDataFrame([("a", "A", page), ("b", "B", "only one part")], "basename string, title string, page_text string")
    anchors = spark.createDataFrame([(7, "before it", "# the section", "after it")], "sample_id bigint, before string, section string, after string")
    got = context.pack_contexts(q, a, budget="own", anchors=anchors).first()
    # 17 less the lead's 4 and the section's 3 leaves 10 of 16: the chunks with a common word first, then in order
    assert got.budget == 17 and got.n_docs == 2 and got.context.count("==========") == 3
    assert "before it\n**Document Title**:  the section\n" in got.context and "lead words stand here\n\n...\nthe mill was red" in got.context
    g = random.Random(7)
    g.normalvariate(54, 30)
    order = ["section", "mill was", "only one"]
    g.shuffle(order)
    assert order == sorted(order, key=lambda w: got.context.find(w) if w in got.context else 1 << 30) or "only one" not in got.context


def test_late_and_failing_calls():
    calls = []

    def slow():
        calls.append(1)
        time.sleep(0.3 if len(calls) == 1 else 0)
        return "x"

    assert clients.with_retries(slow, 2, seconds=0.1) == "x" and len(calls) == 2
    assert clients.with_retries(lambda: 1 / 0, 2) is None
    with pytest.raises(TimeoutError):
        clients.timed(lambda: time.sleep(0.5), 0.05)
    assert adhoc.any_case("a LIKE 'no like' and \"like\" like b") == "a ILIKE 'no like' and \"like\" ILIKE b"


def test_nested_boxes_and_html_tables(spark):
    box = '<table class="infobox"><tr><th>Parts</th><td><table><tr><td>a</td></tr><tr><td>b</td><td>c</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table></td></tr><tr><th class="infobox-label">Bare</th></tr><tr><td>x</td></tr></table>'
    got = html.infoboxes(spark.createDataFrame([(1, box)], "k int, h string"), "k", "h").collect()
    assert [(r.label, r.value) for r in got] == [("Parts", '["a", {"b": "c"}, ["1", "2", "3"]]'), ("Bare", "")]
    c = spark.createDataFrame([(1, 0, 0, "n<1>", "a & b"), (1, 0, 1, "m", None), (1, 1, 0, "n<1>", "<i>"), (1, 1, 1, "m", "z")], "k int, row_idx int, col_idx int, col_name string, text string")
    back = html.cells(cells.to_html(c, "k"), "k", "html").drop("href")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, c.collect()), key=str)


def test_expansion_is_validated(spark):
    class Wide:
        def complete(self, messages):
            return "[[ ## table ## ]]\n<table><tr><th>n</th><th>year</th></tr><tr><td>a</td><td>1901</td></tr><tr><td>b</td><td>" + ("1902" if "Bridge" in messages[-1]["content"] else "1999") + "</td></tr></table>\n[[ ## completed ## ]]"

    t = spark.createDataFrame([(k, "<table><tr><th>n</th></tr><tr><td>a</td></tr><tr><td>b</td></tr></table>") for k in ("good", "bad")], "table_id string, html string")
    s = spark.createDataFrame([("good", 0, "A", "built 1901"), ("good", 1, "Bridge", "built 1902"), ("bad", 0, "A", "built 1901"), ("bad", 1, "B", "built 1902")], "table_id string, row_idx int, title string, summary string")
    got = {r.table_id: (r.verdict, r.expanded_table_html != "") for r in pages.expanded(t, s, Wide).collect()}
    assert got == {"good": ("ok", True), "bad": ("not_in_summary", False)}
