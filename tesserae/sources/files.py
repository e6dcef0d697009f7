"""Files in and out: JSON lines, title lists, templates, attempts by file name, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserae.session import cut_lineage

# Schemas of the record files.
METADATA = "struct<caption: string, header_levels: array<string>, footer_info: array<string>, page_title: string, section_title: string, hatnote: string, references_content: string>"
PAGE = "struct<page_title: string, page_summary: string, page_url: string, page_id: bigint, revision_id: bigint, parent_id: bigint>"
TABLE_RECORD = f"table_id string, page_metadata {PAGE}, table_metadata {METADATA}, original_table_html string, expanded_table_html string, notes string, new_columns array<string>, new_evidence_wikipages array<string>, table_shape array<int>"
QUESTION_RECORD = f"table_id string, metadata {METADATA}, df string, brainstorm string, question string, condition_col string, question_quality struct<discussion: string, complexity_rating: int, self_containedness_rating: int, naturalness_rating: int>, sql_query string, python_code string, final_answer_sql string, final_answer_python string, dfc_judgment boolean, reasoning_traces string"
SEARCH_RECORD = "table_id string, question string, relevant_web_urls array<string>, relevant_web_articles array<string>"


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Strict: a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines): blank lines and empty objects are skipped, malformed lines set aside. A .json file is one array."""
    s = T._parse_datatype_string(schema) if hasattr(T, "_parse_datatype_string") else spark.createDataFrame([], schema).schema
    full = T.StructType([*s.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = cut_lineage(spark.read.schema(full).option("mode", "PERMISSIVE").option("multiLine", str(path.endswith(".json")).lower()).json(path))  # read once for both results
    some = F.greatest(*(F.col(f"`{n}`").isNotNull().cast("int") for n in s.names), F.lit(0)) == 1
    return raw.where(F.col("_corrupt_record").isNull() & some).drop("_corrupt_record"), raw.where(F.col("_corrupt_record").isNotNull()).select(F.col("_corrupt_record").alias("line"))


def read_lines(spark: SparkSession, path: str, keep_blank: bool = False, comments: bool = True) -> DataFrame:
    """(seq, value): lines in file order. Without keep_blank blank ones go; without comments lines that begin with #."""
    raw = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"))
    out = raw.withColumn("seq", F.col("_at").getField("col3") if "col3" in raw.schema["_at"].dataType.names else F.monotonically_increasing_id()).drop("_at")
    if not keep_blank:
        out = out.where(F.trim("value") != "")
    return out if comments else out.where(~F.trim("value").startswith("#"))


def read_titles_by_year(spark: SparkSession, path: str) -> DataFrame:
    """(seq, year, title) of a file of '# year' lines, each followed by titles."""
    lines = read_lines(spark, path)
    year = F.regexp_extract("value", r"^#\s*(\d{4})", 1)
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)  # one small list
    return lines.withColumn("year", F.last(F.nullif(year, F.lit("")), ignorenulls=True).over(w)).where(~F.col("value").startswith("#")).select("seq", F.col("year").cast("int").alias("year"), F.trim("value").alias("title"))


def read_template(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def read_attempts(spark: SparkSession, pattern: str, schema: str, name: str = r"([A-Za-z0-9]+)_(\d+)\.jsonl?$") -> DataFrame:
    """Records of many files with setting and attempt_no from each file's name."""
    df = spark.read.schema(schema).json(pattern).withColumn("_f", F.col("_metadata.file_name"))
    return df.withColumn("setting", F.regexp_extract("_f", name, 1)).withColumn("attempt_no", F.regexp_extract("_f", name, 2).cast("int")).drop("_f")


def read_pieces(spark: SparkSession, path: str, separator: str = "#-----#") -> DataFrame:
    """(seq, html) of a file of several HTML samples; blank pieces are skipped."""
    return spark.read.text(path, lineSep=separator).select(F.monotonically_increasing_id().alias("seq"), F.trim("value").alias("html")).where(F.regexp_replace("html", r"\s", "") != "")


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_new(rows: DataFrame, seen: DataFrame, blocked: DataFrame, key: str, path: str) -> None:
    """Appends trimmed, non-empty keys that are neither seen nor blocked, each once."""
    new = rows.select(F.trim(key).alias(key)).where(F.col(key) != "").distinct()
    new.join(seen.select(key), key, "left_anti").join(blocked.select(key), key, "left_anti").write.mode("append").parquet(path)


def verify_written(df: DataFrame, path: str) -> bool:
    """Whether what was written reads back as the same bag of rows."""
    back = df.sparkSession.read.schema(df.schema).json(path)
    return df.exceptAll(back).isEmpty() and back.exceptAll(df).isEmpty()


def grouped_titles(df: DataFrame) -> DataFrame:
    """(year, block): the titles of a year below its header line."""
    g = df.groupBy("year").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "title"))), lambda x: x["title"]).alias("t"))
    return g.select("year", F.rtrim(F.concat(F.lit("# "), F.col("year").cast("string"), F.lit("\n"), F.array_join("t", "\n"))).alias("block"))


def sample_report(df: DataFrame, order: str, n: int, columns: Sequence[str], needs: str | None = None) -> DataFrame:
    """(seq, report): the first n records as markdown; those without the needed field are left out after counting."""
    top = df.orderBy(order).limit(n)
    if needs:
        top = top.where(F.coalesce(F.col(needs).cast("string"), F.lit("")) != "")
    parts = [F.concat(F.lit(f"### {c}\n\n"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return top.select(F.col(order).alias("seq"), F.concat_ws("\n\n", *parts).alias("report"))
