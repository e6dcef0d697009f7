"""Ad-hoc queries: Spark SQL over a table's cells, each record's own SQL over its own table, and answer comparison."""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = 2_000_000  # virtual machine steps after which a record's query comes out as an error that says interrupted; the default of a parameter
DENIED = {sqlite3.SQLITE_ATTACH, sqlite3.SQLITE_DETACH, sqlite3.SQLITE_PRAGMA} if hasattr(sqlite3, "SQLITE_ATTACH") else {24, 25, 19}
NUMBER = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?")


def wide(cells: DataFrame, key: str, value: object) -> DataFrame:
    """One table's cells as a wide DataFrame with its own columns, numeric where every value is a number."""
    from tesserae.operators.cells import column_types

    one = cells.where(F.col(key) == F.lit(value))
    types = sorted(column_types(one, key).collect(), key=lambda r: r["col_idx"])
    pick = lambda j: F.max(F.when(F.col("col_idx") == j, F.col("text")))
    cols = [(pick(t["col_idx"]).cast("double") if t["inferred"] == "numeric" else pick(t["col_idx"])).alias(t["col_name"]) for t in types]
    return one.groupBy("row_idx").agg(*cols).orderBy("row_idx").drop("row_idx")


def any_case(sql: str) -> str:
    """LIKE as ILIKE, outside of string literals and quoted names."""
    return re.sub(r"('(?:[^']|'')*'|\"(?:[^\"]|\"\")*\")|\bLIKE\b", lambda m: m.group(1) or "ILIKE", sql, flags=re.I)


def run_sql(spark: SparkSession, cells: DataFrame, key: str, value: object, sql: str) -> DataFrame:
    """A query over one table named df; double quotes name identifiers."""
    wide(cells, key, value).createOrReplaceTempView("df")
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        return spark.sql(any_case(sql))
    finally:
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", before)


def strip_fence(sql: str) -> str:
    m = re.search(r"```(?:sql)?\s*(.*?)```", sql, re.S)
    return (m.group(1) if m else sql).strip()


def read_pipe_table(md: str) -> tuple[list[str], list[list[str | None]]]:
    rows = [[c.strip() for c in x.strip().removeprefix("|").removesuffix("|").split("|")] for x in md.split("\n") if x.strip()]
    if not rows:
        return [], []
    names, seen = [], {}
    for n in rows[0]:
        k = seen[n] = seen.get(n, 0) + 1
        names.append(n if k == 1 else f"{n}.{k - 1}")
    body = [r for r in rows[1:] if not all(re.fullmatch(r":?-+:?", c) for c in r)]
    return names, [[c or None for c in (r + [""] * len(names))[: len(names)]] for r in body]


def query_table(md: str, sql: str, steps: int | None = STEPS) -> tuple[str, int, int, str]:
    """(state, rows, columns, answer) of a SELECT over an in-memory table named df; state is ok, empty or error.

    The database holds only that table, can't reach files, and is stopped after a number of steps, or never without one.
    """
    names, body = read_pipe_table(md)
    con = sqlite3.connect(":memory:")
    try:
        if not names:
            return "error", 0, 0, "no table"
        numeric = [all(r[j] is None or NUMBER.fullmatch(r[j]) for r in body) for j in range(len(names))]
        q = lambda n: '"' + n.replace('"', '""') + '"'
        con.execute("CREATE TABLE df (" + ", ".join(f"{q(n)} {'NUMERIC' if numeric[j] else 'TEXT'}" for j, n in enumerate(names)) + ")")
        con.executemany(f"INSERT INTO df VALUES ({', '.join('?' * len(names))})", body)
        con.commit()
        con.set_authorizer(lambda action, *_: sqlite3.SQLITE_DENY if action in DENIED else sqlite3.SQLITE_OK)
        left = [(steps or 0) // 1000]

        def tick() -> int:
            left[0] -= 1
            return int(left[0] <= 0)

        if steps:
            con.set_progress_handler(tick, 1000)
        cur = con.execute(strip_fence(sql))
        rows = cur.fetchall()
        if not rows:
            return "empty", 0, len(cur.description or ()), ""
        text = lambda v: "" if v is None else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
        return "ok", len(rows), len(rows[0]), "\n".join(" | ".join(map(text, r)) for r in rows)
    except (sqlite3.Error, sqlite3.Warning, ValueError) as e:
        return "error", 0, 0, str(e)
    finally:
        con.close()


def run_own_sql(records: DataFrame, key: str, markdown: str = "df", sql: str = "sql_query", steps: int | None = STEPS) -> DataFrame:
    """(key, state, n_rows, n_cols, answer): every record's own query over its own table, on the executors.

    A null table or query gives state null.
    """
    kind = dict(records.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, md, s in zip(b[key].tolist(), b[markdown].tolist(), b[sql].tolist(), strict=True):
                out.append((k, *((None, None, None, None) if md is None or s is None else query_table(md, s, steps))))
            yield pd.DataFrame(out, columns=[key, "state", "n_rows", "n_cols", "answer"]).astype({"n_rows": "Int32", "n_cols": "Int32"})

    return records.select(key, markdown, sql).mapInPandas(run, f"{key} {kind}, state string, n_rows int, n_cols int, answer string")


def run_own_code(df: DataFrame, code: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The second path to an answer: a function over the DataFrame. Text of unknown origin is never executed."""
    return code(df)


def normal_answer(x: str) -> Column:
    """An answer as it is compared: case, blanks, a final full stop and digit grouping don't count."""
    t = F.lower(F.trim(F.regexp_replace(F.col(x), r"\s+", " ")))
    t = F.regexp_replace(F.regexp_replace(t, r" ?\.$", ""), r"(?<=\d),(?=\d{3}(\D|$))", "")
    return t


def same_answer(a: str, b: str, tolerance: float = 1e-6) -> Column:
    """Whether two answers agree, as text or as numbers within a relative tolerance; null if either is null."""
    plain = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
    na, nb = normal_answer(a), normal_answer(b)
    num = na.rlike(plain) & nb.rlike(plain)
    x, y = na.try_cast("double"), nb.try_cast("double")
    return F.when(F.col(a).isNull() | F.col(b).isNull(), None).otherwise((na == nb) | F.when(num, F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y), F.lit(1.0))).otherwise(False))


def same_rows(a: DataFrame, b: DataFrame, digits: int = 6) -> bool:
    """Bag equality of two small results: order of rows and columns doesn't count, nor a single column's name; floats are rounded."""
    if len(a.columns) != len(b.columns):
        return False
    if len(a.columns) == 1:
        a, b = a.toDF("v"), b.toDF("v")
    elif sorted(a.columns) != sorted(b.columns):
        return False
    fit = lambda d: d.select(*(F.round(F.col(f"`{n}`").cast("double"), digits).cast("string").alias(n) if t in ("double", "float", "int", "bigint") else F.col(f"`{n}`").cast("string").alias(n) for n, t in sorted(d.dtypes)))
    x, y = fit(a), fit(b)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
