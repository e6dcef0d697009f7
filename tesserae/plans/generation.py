"""Stages that ask a model: prompts from named fields, replies read by section markers, traces, sampling, expansion.

Every stage is a function over rows with a client factory, so a stub runs it offline; a task that is run again asks again,
so results should be written before they are used further.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions.text import repair_markers
from tesserae.operators.adhoc import same_answer
from tesserae.sources.clients import ModelClient, complete_all


def prompt(instructions: str, fields: Sequence[str], wanted: Sequence[str]) -> Column:
    """Instructions, then every field under its marker, then the markers that the reply should have."""
    parts = [F.lit(instructions)]
    parts += [F.concat(F.lit(f"[[ ## {f} ## ]]\n"), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields]
    parts.append(F.lit("Reply with " + ", ".join(f"[[ ## {w} ## ]]" for w in wanted) + " and end with [[ ## completed ## ]]."))
    return F.concat_ws("\n\n", *parts)


def section(text: str | Column, name: str, kind: str = "string") -> Column:
    """The reply's section of that name, trimmed and cast; null if it is absent or doesn't fit the type."""
    t = repair_markers(text)
    rx = rf"(?s)\[\[ ## {re.escape(name)} ## \]\]\s*(.*?)\s*(?:\[\[ ## |\z)"
    got = F.when(t.rlike(rf"\[\[ ## {re.escape(name)} ## \]\]"), F.regexp_extract(t, rx, 1))
    return got if kind == "string" else got.try_cast(kind)


def ask(rows: DataFrame, key: str, instructions: str, fields: Sequence[str], wanted: dict[str, str], make: Callable[[], ModelClient], tries: int = 3) -> DataFrame:
    """(key, completion, one column per wanted section) for every row; a row whose calls all fail has nulls."""
    asked = rows.select(key, prompt(instructions, fields, list(wanted)).alias("_prompt"))
    said = complete_all(asked, key, "_prompt", make, tries)
    return said.select(key, "completion", *(section("completion", n, t).alias(n) for n, t in wanted.items()))


def question_trials(tables: DataFrame, make: Callable[[], ModelClient], trials: int = 3) -> DataFrame:
    """(table_id, trial, question, sql_query, ratings): so many trials a table, failed ones included; the first that
    passes the gate is what a caller keeps."""
    t = tables.select("table_id", "df", F.explode(F.array(*map(F.lit, range(1, trials + 1)))).alias("trial")).withColumn("_key", F.concat_ws("#", "table_id", "trial"))
    wanted = {"question": "string", "sql_query": "string", "complexity_rating": "int", "self_containedness_rating": "int", "naturalness_rating": "int"}
    return t.select("_key", "table_id", "trial").join(ask(t, "_key", "Write a question about the table and SQLite that answers it.", ["df", "trial"], wanted, make), "_key").drop("_key")


def passes_gate() -> Column:
    return (F.col("complexity_rating") >= 3) & (F.col("self_containedness_rating") >= 4) & (F.col("naturalness_rating") >= 4)


def generate_traces(samples: DataFrame, key: str, make: Callable[[], ModelClient]) -> DataFrame:
    """Samples with a reasoning trace written from context, question and answer; a sample without a reply is left out."""
    got = ask(samples, key, "Explain how the documents lead to the answer.", ["context", "question", "final_answer_sql"], {"reasoning": "string"}, make)
    trace = F.coalesce("reasoning", "completion")
    return samples.join(got.where(F.col("completion").isNotNull()).select(key, trace.alias("reasoning_traces")), key)


def sample_attempts(samples: DataFrame, key: str, settings: Sequence[str], attempts: int, make: Callable[[], ModelClient]) -> DataFrame:
    """(key, setting, attempt_no, trace, answer, answer_comparison): attempts without the answer at hand, each compared with it."""
    grid = samples.select(key, "context", "question", "final_answer_sql", F.explode(F.array(*map(F.lit, settings))).alias("setting"))
    grid = grid.withColumn("attempt_no", F.explode(F.sequence(F.lit(1), F.lit(attempts)))).withColumn("_key", F.concat_ws("#", F.col(key).cast("string"), "setting", "attempt_no"))
    got = ask(grid, "_key", "Answer from the documents.", ["context", "question", "setting", "attempt_no"], {"reasoning": "string", "answer": "string"}, make)
    j = grid.join(got, "_key")
    return j.select(key, "setting", "attempt_no", F.col("reasoning").alias("llm_generated_reasoning_traces"), "answer", F.coalesce(same_answer("answer", "final_answer_sql"), F.lit(False)).alias("answer_comparison"))


ATTEMPT_FIELDS = ["sample_id", "table_id", "question", "final_answer_sql", "relevant_web_urls", "evidence_wikipages"]


def attempt_inputs(samples: DataFrame, from_table: bool = False) -> DataFrame:
    """What an attempt is given: six named fields and the context, which is the table's markdown if from_table is set."""
    return samples.select(*ATTEMPT_FIELDS, F.col("df_md" if from_table else "context").alias("context"))


def cross_checked(trials: DataFrame, first: str, second: str) -> DataFrame:
    """Trials whose two paths to an answer agree, the first one of each table; a trial that lacks an answer doesn't count."""
    ok = trials.where(F.coalesce(same_answer(first, second), F.lit(False)))
    return ok.groupBy("table_id").agg(F.min_by(F.struct(*[x for x in trials.columns if x != "table_id"]), "trial").alias("_s")).select("table_id", "_s.*")


def expand_tables(tables: DataFrame, summaries: DataFrame, make: Callable[[], ModelClient], tries: int = 2) -> DataFrame:
    """(table_id, expanded_table_html): a model's table with more columns from the summaries of the pages that rows link to;
    '' where it gives none. tables: table_id, html; summaries: table_id, row_idx, title, summary."""
    block = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "title", "summary"))), lambda x: F.concat(F.lit("## "), x["title"], F.lit("\n"), x["summary"])), "\n\n")
    s = summaries.groupBy("table_id").agg(block.alias("evidence"))
    got = ask(tables.join(s, "table_id"), "table_id", "Add columns that the evidence supports.", ["html", "evidence"], {"table": "string"}, make, tries)
    ok = F.col("table").rlike("(?is)<table.*</table>")
    return tables.select("table_id").join(got, "table_id", "left").select("table_id", F.when(ok, F.col("table")).otherwise("").alias("expanded_table_html"))


def shuffled(df: DataFrame, key: str, seed: int = 2026) -> DataFrame:
    """Rows in an order that depends on their key and a seed alone."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
