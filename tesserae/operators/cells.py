"""Tables of any schema as one relation of cells: gates, typing, reshaping, validation and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.text import NULLISH, href_to_title

# Sizes of a table that is neither too small nor too large.
MIN_ROWS, MAX_ROWS, MIN_COLS, MAX_COLS, MAX_CELLS = 5, 30, 2, 8, 150
NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def from_markdown(df: DataFrame, key: str, markdown: str, drop_blank: bool = False) -> DataFrame:
    """(key, row_idx, col_idx, col_name, text) of a pipe table: cells trimmed, blank cells null, a nameless first column
    called Index, and dropped if it only counts the rows. With drop_blank blank cells are left out and rows move up."""
    lines = F.filter(F.transform(F.split(F.col(markdown), "\n"), F.trim), lambda x: x != "")
    cut = lambda x: F.transform(F.split(F.regexp_replace(F.regexp_replace(x, r"^\|", ""), r"\|$", ""), r"\|"), lambda t: F.trim(t))
    t = df.where(F.col(markdown).isNotNull()).select(key, lines.alias("_l")).where(F.size("_l") >= 2)
    t = t.select(key, cut(F.get("_l", F.lit(0))).alias("_h"), F.slice("_l", 2, F.size("_l")).alias("_b"))
    t = t.withColumn("_b", F.filter("_b", lambda x: ~x.rlike(r"^[|:\-\s]+$")))
    r = t.select(key, "_h", F.posexplode("_b").alias("row_idx", "_x"))
    cells = F.filter(cut(F.col("_x")), lambda v: v != "") if drop_blank else cut(F.col("_x"))
    c = r.select(key, "_h", "row_idx", F.posexplode(cells).alias("col_idx", "_t"))
    name = F.get("_h", F.col("col_idx"))
    c = c.select(key, "row_idx", "col_idx", F.when((F.col("col_idx") == 0) & (name == ""), "Index").otherwise(name).alias("col_name"), F.nullif("_t", F.lit("")).alias("text")).where(F.col("col_name").isNotNull())
    counts = c.where("col_idx = 0 and col_name = 'Index'").groupBy(key).agg(F.bool_and(F.coalesce(F.col("text") == F.col("row_idx").cast("string"), F.lit(False))).alias("_counts"))
    c = c.join(counts, key, "left").where(~(F.coalesce("_counts", F.lit(False)) & (F.col("col_idx") == 0)))
    return c.select(key, "row_idx", F.when(F.coalesce("_counts", F.lit(False)), F.col("col_idx") - 1).otherwise(F.col("col_idx")).alias("col_idx"), "col_name", "text")


def to_markdown(cells: DataFrame, key: str) -> DataFrame:
    """(key, markdown): rows and columns in order; a null cell is blank."""
    w = lambda x: F.concat(F.lit("| "), F.array_join(x, " | "), F.lit(" |"))
    text = F.coalesce("text", F.lit(""))
    rows = cells.groupBy(key, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col_idx", text.alias("t"), "col_name"))).alias("c"))
    rows = rows.select(key, "row_idx", w(F.transform("c", lambda x: x["t"])).alias("line"), F.transform("c", lambda x: x["col_name"]).alias("names"))
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("row_idx", "line"))).alias("r"), F.min_by("names", "row_idx").alias("names"))
    rule = w(F.transform("names", lambda _: F.lit("---")))
    return g.select(key, F.array_join(F.concat(F.array(w(F.col("names")), rule), F.transform("r", lambda x: x["line"])), "\n").alias("markdown"))


def to_html(cells: DataFrame, key: str) -> DataFrame:
    """(key, html): a table of one head row and its body, texts escaped, a null cell empty."""
    safe = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = lambda a, tag: F.concat(F.lit("<tr>"), F.array_join(F.transform(a, lambda x: F.concat(F.lit(f"<{tag}>"), safe(x), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    text = F.coalesce("text", F.lit(""))
    rows = cells.groupBy(key, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col_idx", text.alias("t"), "col_name"))).alias("c"))
    rows = rows.select(key, "row_idx", row(F.transform("c", lambda x: x["t"]), "td").alias("line"), row(F.transform("c", lambda x: x["col_name"]), "th").alias("head"))
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("row_idx", "line"))).alias("r"), F.min_by("head", "row_idx").alias("head"))
    return g.select(key, F.concat(F.lit("<table>"), "head", F.array_join(F.transform("r", lambda x: x["line"]), ""), F.lit("</table>")).alias("html"))


def gate(cells: DataFrame, key: str) -> DataFrame:
    """Per table its size and whether it is regular (no null, no repeated name, rows + columns >= 4) and of ideal size."""
    g = cells.groupBy(key).agg(
        (F.max("row_idx") + 1).alias("n_rows"),
        (F.max("col_idx") + 1).alias("n_cols"),
        F.count_if(F.col("text").isNull()).alias("n_null"),
        F.count_distinct("col_name").alias("n_names"),
    )
    regular = (F.col("n_rows") + F.col("n_cols") >= 4) & (F.col("n_null") == 0) & (F.col("n_names") == F.col("n_cols"))
    ideal = F.col("n_rows").between(MIN_ROWS, MAX_ROWS) & F.col("n_cols").between(MIN_COLS, MAX_COLS) & (F.col("n_rows") * F.col("n_cols") <= MAX_CELLS)
    return g.withColumn("regular", regular).withColumn("ideal", ideal)


def good_tables(records: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """Records whose table is expanded or of ideal size, with its shape."""
    g = gate(cells, key).select(key, "n_rows", "n_cols", "ideal")
    return records.join(g, key).where((F.coalesce("expanded_table_html", F.lit("")) != "") | F.col("ideal"))


def column_types(cells: DataFrame, key: str) -> DataFrame:
    """(key, col_idx, col_name, inferred): numeric only if every value that is there converts; empty columns are empty."""
    g = cells.groupBy(key, "col_idx", "col_name").agg(F.bool_and(F.col("text").isNull() | F.col("text").rlike(NUMERIC)).alias("num"), F.count("text").alias("n"))
    return g.select(key, "col_idx", "col_name", F.when(F.col("n") == 0, "empty").when(F.col("num"), "numeric").otherwise("text").alias("inferred"))


def drop_empty(cells: DataFrame, key: str) -> DataFrame:
    """Cells without the rows that are all null, then without the columns that are; numbered anew."""
    rows = cells.groupBy(key, "row_idx").agg(F.count("text").alias("n")).where("n > 0").drop("n")
    c = cells.join(rows, [key, "row_idx"], "left_semi")
    cols = c.groupBy(key, "col_idx").agg(F.count("text").alias("n")).where("n > 0").drop("n")
    c = c.join(cols, [key, "col_idx"], "left_semi")
    rank = lambda x: F.dense_rank().over(Window.partitionBy(key).orderBy(x)) - 1
    return c.withColumn("_r", rank("row_idx")).withColumn("_c", rank("col_idx")).drop("row_idx", "col_idx").withColumnsRenamed({"_r": "row_idx", "_c": "col_idx"})


def split_footer(cells: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(body cells, (key, footer_info)): the last row of a table of more than one row and two columns moves to the footer
    if its distinct non-empty cells number at most two; the footer is sorted by text and link."""
    w = Window.partitionBy(key)
    size = cells.withColumn("_rows", F.max("row_idx").over(w) + 1).withColumn("_cols", F.max("col_idx").over(w) + 1)
    last = size.where((F.col("row_idx") == F.col("_rows") - 1) & (F.col("_rows") > 1) & (F.col("_cols") > 2))
    href = F.coalesce("href", F.lit("")) if "href" in cells.columns else F.lit("")
    foot = last.where(F.coalesce("text", F.lit("")) != "").groupBy(key, "row_idx").agg(F.sort_array(F.collect_set(F.struct("text", href.alias("href")))).alias("f")).where(F.size("f") <= 2)
    foot = foot.select(key, "row_idx", F.transform("f", lambda x: x["text"]).alias("footer_info"))
    return cells.join(foot.select(key, "row_idx"), [key, "row_idx"], "left_anti"), foot.drop("row_idx")


def unfold(cells: DataFrame, key: str) -> DataFrame:
    """Column groups that repeat side by side put below each other: the g-th occurrences of all names form group g, and a
    group that lacks a name is dropped. Names lose a .N suffix."""
    base = F.regexp_replace("col_name", r"\.\d+$", "")
    occ = F.row_number().over(Window.partitionBy(key, "row_idx", "_base").orderBy("col_idx"))
    c = cells.withColumn("_base", base).withColumn("_occ", occ)
    w = Window.partitionBy(key)
    info = c.groupBy(key).agg(F.size(F.collect_set("_base")).alias("_n_base"), (F.max("row_idx") + 1).alias("_n_rows"))
    whole = c.groupBy(key, "_occ").agg(F.size(F.collect_set("_base")).alias("_have"))
    c = c.join(info, key).join(whole, [key, "_occ"]).where("_have = _n_base")
    first = F.min(F.when(F.col("_occ") == 1, F.col("col_idx"))).over(Window.partitionBy(key, "_base"))
    c = c.withColumn("_first", first)
    return c.select(key, ((F.col("_occ") - 1) * F.col("_n_rows") + F.col("row_idx")).cast("int").alias("row_idx"), (F.dense_rank().over(w.orderBy("_first")) - 1).alias("col_idx"), F.col("_base").alias("col_name"), "text")


def reference_columns(cells: DataFrame, key: str, threshold: float = 1.0) -> DataFrame:
    """(key, col_name, fraction, titles): the first column whose share of article links reaches the threshold, and the
    titles that its rows link to, in order."""
    title = href_to_title("href")
    g = cells.withColumn("_t", title).groupBy(key, "col_idx", "col_name").agg(F.avg(F.col("_t").isNotNull().cast("int")).alias("fraction"), F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "_t"))), lambda x: x["_t"]).alias("titles"))
    g = g.where(F.col("fraction") >= threshold).groupBy(key).agg(F.min_by(F.struct("col_name", "fraction", "titles"), "col_idx").alias("s"))
    return g.select(key, "s.*")


def validate_expansion(original: DataFrame, expanded: DataFrame, summaries: DataFrame, key: str) -> DataFrame:
    """(key, verdict, n_new): why an expanded table is rejected, or ok.

    New columns of fewer than two distinct values are dropped; none left, a repeated name, two null-free new columns of
    the same sorted values, or a value that its row's summary doesn't hold rejects. A value is held if the summary has
    it, or all its parts between commas, semicolons and brackets. summaries: key, row_idx, summary.
    """
    names = original.select(key, "col_name").distinct()
    new = expanded.join(names, [key, "col_name"], "left_anti")
    filled = F.when(F.lower(F.trim("text")).isin(NULLISH), None).otherwise(F.trim("text"))
    new = new.withColumn("v", filled)
    col = new.groupBy(key, "col_idx", "col_name").agg(F.count_distinct("v").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"), F.array_sort(F.collect_list("v")).alias("vs")).where("n >= 2")
    doubled = col.where("nulls = 0").groupBy(key, "vs").agg(F.count("*").alias("_times")).where("_times > 1").select(key).distinct().withColumn("doubled", F.lit(True))
    repeated = expanded.select(key, "col_idx", "col_name").distinct().groupBy(key, "col_name").agg(F.count("*").alias("_times")).where("_times > 1").select(key).distinct().withColumn("repeated", F.lit(True))
    low = F.lower("summary")
    parts = F.filter(F.transform(F.split(F.lower("v"), r"[,;)(]"), lambda x: F.trim(x)), lambda x: x != "")
    held = F.contains(low, F.lower("v")) | F.forall(parts, lambda x: F.contains(F.lower(F.col("summary")), x))
    kept = new.join(col.select(key, "col_idx"), [key, "col_idx"], "left_semi").where(F.col("v").isNotNull())
    loose = kept.join(summaries, [key, "row_idx"], "left").where(~F.coalesce(held, F.lit(False))).groupBy(key).agg(F.count("*").alias("loose"))
    n_new = col.groupBy(key).agg(F.count("*").alias("n_new"))
    j = expanded.select(key).distinct().join(n_new, key, "left").join(repeated, key, "left").join(doubled, key, "left").join(loose, key, "left")
    verdict = F.when(F.col("n_new").isNull(), "no_new_column").when(F.col("repeated"), "repeated_name").when(F.col("doubled"), "duplicate_column").when(F.col("loose") > 0, "not_in_summary").otherwise("ok")
    return j.select(key, verdict.alias("verdict"), F.coalesce("n_new", F.lit(0)).alias("n_new"))


def simplified(cells: DataFrame, key: str) -> DataFrame:
    """(key, answer_kind, answer): one cell as its text, one column as a list, one row as pairs, anything else as markdown."""
    g = cells.groupBy(key).agg((F.max("row_idx") + 1).alias("r"), (F.max("col_idx") + 1).alias("c"), F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "col_idx", "text", "col_name"))), lambda x: F.struct(x["col_name"].alias("n"), F.coalesce(x["text"], F.lit("")).alias("t"))).alias("v"))
    md = to_markdown(cells, key)
    q = lambda x: F.concat(F.lit("'"), x, F.lit("'"))
    kind = F.when((F.col("r") == 1) & (F.col("c") == 1), "value").when(F.col("c") == 1, "list").when(F.col("r") == 1, "pairs").otherwise("table")
    as_list = F.concat(F.lit("["), F.array_join(F.transform("v", lambda x: q(x["t"])), ", "), F.lit("]"))
    as_pairs = F.concat(F.lit("{"), F.array_join(F.transform("v", lambda x: F.concat(q(x["n"]), F.lit(": "), q(x["t"]))), ", "), F.lit("}"))
    answer: Column = F.when(kind == "value", F.col("v")[0]["t"]).when(kind == "list", as_list).when(kind == "pairs", as_pairs).otherwise(F.col("markdown"))
    return g.join(md, key).select(key, kind.alias("answer_kind"), answer.alias("answer"))
