"""Session factory, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "tesserae", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine relies on; on a cluster the session comes from outside."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERAE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. Without that setting a process on one machine (tests, bench) takes a
    temporary one, and a cluster is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc._jsc.sc().getCheckpointDir()
        named = named.get() if named.isDefined() else None
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tesserae-ckpt-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write the rows to the shared checkpoint folder, so that losing an executor never recomputes what lies before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def thinned(df: DataFrame, key: str, limit: int, spare: int = 20) -> DataFrame:
    """About spare * limit rows by the hash of their key, or all if there are no more: what a bounded sample is then
    picked from, so that no task ever sorts a large table for it. The count reads no column."""
    n = df.count()
    if n <= spare * limit:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(29)), F.lit(1 << 30)) < int((1 << 30) * spare * limit / n))


BROADCAST_BYTES = 32 << 20  # bytes, at most, of a side that is sent to every task


def if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for a broadcast join if its rows, counted first, hold at most most bytes; else df as it is."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    size = sum(wide, F.lit(16 * len(df.columns)))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most else df


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a table has so few splits that Python work on it would leave cores idle.

    A plan with a shuffle is passed on as it is: asking for its number of partitions would run it. So is a large table,
    which has more splits than cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if re.search(r"\b(?:Join|Aggregate|Window|Sort|Repartition\w*|RebalancePartitions|Deduplicate|Intersect|Except)\b", plan.optimizedPlan().toString()):
        return df
    return df.repartition(cores) if plan.toRdd().getNumPartitions() < cores else df
