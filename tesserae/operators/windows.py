"""Order-dependent operators as windows over an explicit ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.session import cut_lineage


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first k rows of every key in the given order; rows with a null key are left out."""
    for x in keys:
        df = df.where(F.col(x).isNotNull())
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in the given order, as a map filled row by row would hold it. A null key is a key.

    Done as an aggregate with map-side combine, so a hot key costs one row per task, not a sorted group.
    """
    rest = [x for x in df.columns if x not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_s"))
    return best.select(*keys, *(F.col("_s")[x].alias(x) for x in rest)).select(*df.columns)


def budget_prefix(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], size: str, budget: int | Column) -> DataFrame:
    """The rows of every key, in order, whose running total stays within the budget; it ends at the first that doesn't fit."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(size).over(w)).where(F.col("running") <= budget)


def dense_ordinal(df: DataFrame, order: str, name: str = "ordinal", buckets: int = 200) -> DataFrame:
    """0-based global ordinal by a sort key: counts per range bucket are summed up, rows are numbered within buckets."""
    ranged = cut_lineage(df.repartitionByRange(buckets, order).withColumn("_b", F.spark_partition_id()))  # one choice of ranges
    counts = ranged.groupBy("_b").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1)
    return numbered.join(F.broadcast(starts), "_b").withColumn(name, F.col("_i") + F.col("_start")).drop("_b", "_i", "_start")  # one row per bucket


def slices(df: DataFrame, order: str, parts: int, buckets: int = 200) -> DataFrame:
    """Adds ordinal and slice: the i-th of parts contiguous slices holds the rows [(i-1) n / T, i n / T)."""
    n = df.count()
    r = dense_ordinal(df, order, buckets=buckets)
    return r.withColumn("slice", F.expr(f"({parts} * (ordinal + 1) + {n} - 1) div {max(n, 1)}").cast("int"))


def resume_after(rows: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    """Rows after the first input row that has the key of the last row done; all rows if nothing is done."""
    last = done.agg(F.max_by(key, order).alias("k")).first()["k"]
    if last is None:
        return rows
    at = rows.where(F.col(key) == last).agg(F.min(order).alias("at")).first()["at"]
    return rows if at is None else rows.where(F.col(order) > at)


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet, failed ones before the last included."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
