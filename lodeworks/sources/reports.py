"""Quality reports as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "system string, table_name string, score double, grade string, passed bigint, failed bigint, "
    "details array<struct<expectation:string,column_name:string,unexpected_count:bigint,unexpected_pct:double,error:string>>"
)


def build_report(results: DataFrame, scores: DataFrame) -> DataFrame:
    """One nested row per table: the score and the failed rules. A table has a handful of rules."""
    detail = F.struct("expectation", "column_name", "unexpected_count", "unexpected_pct", "error")
    failed = (
        results.where(~F.col("success"))
        .groupBy("system", "table_name")
        .agg(F.array_sort(F.collect_list(detail)).alias("details"))
    )
    return scores.join(failed, ["system", "table_name"], "left").select(
        "system", "table_name", "score", "grade", "passed", "failed", "details"
    )


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)
