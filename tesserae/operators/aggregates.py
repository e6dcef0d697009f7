"""Aggregates of the sampling and filtering stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EASY_ABOVE = 0.8  # share of matching attempts above which a question counts as easy


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column count, mean, sample standard deviation, minimum, quartiles (interpolated) and maximum."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns))).alias("s")).select("s.*")
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = long.groupBy("name").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), q.alias("q"), F.max("x").alias("max"))
    return g.select("name", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def match_rates(attempts: DataFrame, key: str, matched: str, easy_above: float = EASY_ABOVE, keep_failed: bool = False) -> DataFrame:
    """Per key total, matches, rate and bucket: failed without a match, easy above the rate, else hard.

    A null judgment counts as no match. kept tells what goes on: hard ones, and with keep_failed the failed ones, too.
    """
    g = attempts.groupBy(key).agg(F.count("*").alias("total"), F.sum(F.coalesce(F.col(matched).cast("int"), F.lit(0))).alias("matches"), F.count_if(F.col(matched).isNull()).alias("unjudged"))
    rate = F.col("matches") / F.col("total")
    bucket = F.when(F.col("matches") == 0, "failed").when(rate > easy_above, "easy").otherwise("hard")
    return g.withColumn("rate", F.round(rate, 6)).withColumn("bucket", bucket).withColumn("kept", (F.col("bucket") == "hard") | ((F.col("bucket") == "failed") & F.lit(keep_failed)))


def first_match(attempts: DataFrame, kept: DataFrame, key: str, matched: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first matching attempt of every (key, by) among the kept keys, as an aggregate rather than a sorted group."""
    rows = attempts.where(F.coalesce(F.col(matched), F.lit(False))).join(kept.select(key).distinct(), key, "left_semi")
    rest = [c for c in rows.columns if c not in (key, *by)]
    best = rows.groupBy(key, *by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_s"))
    return best.select(key, *by, *(F.col("_s")[c].alias(c) for c in rest))


def all_matches(attempts: DataFrame, kept: DataFrame, key: str, matched: str) -> DataFrame:
    """Every matching attempt of the kept keys."""
    return attempts.where(F.coalesce(F.col(matched), F.lit(False))).join(kept.select(key).distinct(), key, "left_semi")
