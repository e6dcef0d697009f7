"""Pages to table records: the steps from a page's HTML to typed, unfolded cells with their context, put together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.operators import cells
from tesserae.plans import generation
from tesserae.session import cut_lineage
from tesserae.sources import html
from tesserae.sources.clients import ModelClient


def processed(raw: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(cells, (key, footer_info)): empty rows and columns dropped, the footer row split off, repeated column groups put
    below each other. raw: the cells of html.cells."""
    body, foot = cells.split_footer(cells.drop_empty(raw, key), key)
    repeats = body.withColumn("_b", F.regexp_replace("col_name", r"\.\d+$", "")).groupBy(key).agg((F.count_distinct("_b") < F.count_distinct("col_idx")).alias("_r")).where("_r").select(key)
    plain = body.join(repeats, key, "left_anti").select(key, "row_idx", "col_idx", "col_name", "text", "href")
    folded = body.join(repeats, key, "left_semi").select(key, "row_idx", "col_idx", "col_name", "text")
    return plain.unionByName(cells.unfold(folded, key).withColumn("href", F.lit(None).cast("string"))), foot


def page_records(pages: DataFrame) -> DataFrame:
    """(page_id, ordinal, section, caption, hatnote, levels, n_rows, n_cols, types, footer_info, reference_column, titles):
    one record per table of every page that is neither a box nor navigation, its cells processed.

    pages: page_id, html. A null or table-less page gives no record; a table without a body row none either.
    """
    t = cut_lineage(html.page_tables(pages).where("route = 'table'").withColumn("table_key", F.concat_ws("#", F.col("page_id").cast("string"), F.col("ordinal").cast("string"))))
    raw = t.select("table_key", F.explode("cells").alias("c")).select("table_key", "c.*")
    body, foot = processed(raw, "table_key")
    size = body.groupBy("table_key").agg((F.max("row_idx") + 1).alias("n_rows"), (F.max("col_idx") + 1).alias("n_cols"))
    types = cells.column_types(body, "table_key").groupBy("table_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "inferred"))), lambda x: x["inferred"]).alias("types"))
    refs = cells.reference_columns(body, "table_key").select("table_key", F.col("col_name").alias("reference_column"), "titles")
    j = t.drop("cells").join(size, "table_key").join(types, "table_key").join(foot, "table_key", "left").join(refs, "table_key", "left")
    return j.select("page_id", "ordinal", "section", "caption", "hatnote", "levels", "n_rows", "n_cols", "types", "footer_info", "reference_column", "titles")


def expanded(tables: DataFrame, summaries: DataFrame, make: Callable[[], ModelClient], tries: int = 2) -> DataFrame:
    """(table_id, expanded_table_html, verdict): a model's wider table if it stands the validation against the summaries
    of the pages that its rows link to, else '' with the reason. tables: table_id, html; summaries: table_id, row_idx,
    title, summary."""
    got = cut_lineage(generation.expand_tables(tables, summaries, make, tries))  # a model is asked once
    said = got.where("expanded_table_html <> ''")
    checked = cells.validate_expansion(html.cells(tables, "table_id", "html"), html.cells(said, "table_id", "expanded_table_html"), summaries, "table_id").select("table_id", "verdict")
    j = got.join(checked, "table_id", "left")
    verdict = F.coalesce("verdict", F.when(F.col("expanded_table_html") == "", "no_reply").otherwise("no_cells"))
    return j.select("table_id", F.when(verdict == "ok", F.col("expanded_table_html")).otherwise("").alias("expanded_table_html"), verdict.alias("verdict"))
