"""File sources and text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CASE_SCHEMA = """
metadata struct<version string, created_date string, description string, generation_method string,
  llm_model string, total_cases int, source_tables struct<legislation string, fines string, policy string>>,
test_cases array<struct<id string, question string, category string, difficulty string,
  expected_behavior struct<sources array<string>, must_retrieve_from_articles array<string>,
    must_retrieve_keywords array<string>, must_retrieve_from_sections array<string>,
    legislation_check struct<must_retrieve_from_articles array<string>>,
    fines_check struct<must_retrieve_keywords array<string>>, must_include_in_answer array<string>>,
  evaluation_method string, data_source string, generation_method string, notes string>>
"""


def scan_whole_text(spark: SparkSession, *paths: str) -> DataFrame:
    """One row (path, text) per file."""
    return spark.read.text(list(paths), wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def scan_files(
    spark: SparkSession, path: str, file_format: str = "binaryFile", pattern: str = "*", **options: str
) -> DataFrame:
    """The files under a path whose name fits the pattern, in any format Spark reads."""
    reader = spark.read.format(file_format).options(**options)
    if pattern != "*":
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def scan_golden_set(
    spark: SparkSession, path: str, limit: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Test cases of golden sets, one row per case; `limit` keeps the first of each set.

    A file is one set, or with multi_line=False one set per line.
    """
    cases = (
        spark.read.schema(CASE_SCHEMA)
        .option("multiLine", multi_line)
        .json(path)
        .select(F.posexplode("test_cases").alias("pos", "case"))
    )
    if limit is not None:
        cases = cases.filter(F.col("pos") < limit)
    return cases.select("pos", "case.*")


def write_report(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Rows as CSV with a header; single_file is for results known to be small."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_text(rows: DataFrame, path: str, order: list[str], line: str = "line", single_file: bool = False) -> str:
    """Lines in the given order, which goes on from one file to the next."""
    ranged = rows.repartition(1).sortWithinPartitions(*order) if single_file else rows.orderBy(*order)
    ranged.select(F.col(line).alias("value")).write.mode("overwrite").text(path)
    return path
