"""Report files in, restored reports and verification results out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.operators.restoring import restore_html
from maskmetrics.session import settle


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, html): one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("report_id"), F.col("value").alias("html"))


def write_reports(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select("report_id", "html").write.mode(mode).parquet(path)


def restore_files(spark: SparkSession, source: str, mapping: DataFrame, target: str) -> None:
    """Restore a whole folder of reports in one job."""
    write_reports(restore_html(read_reports(spark, source), "html", mapping), target)


def write_verification(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Result rows and a one-row total, both as JSON."""
    # Two outputs read the results: they are made once.
    results = settle(results, "verified")
    results.write.mode(mode).json(f"{path}/results")
    totals = results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status").isin("FAIL", "ERROR")).alias("failed"))
    totals.write.mode(mode).json(f"{path}/totals")
