"""The layer pipeline: raw files -> ODS -> cleaned DWD -> aggregated DWA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.cleaning import clean
from lodeworks.plans import marts
from lodeworks.sources import tables as lake
from lodeworks.sources.files import POSITION

# --- fixed values: cleaned table by subject -> source table ---
DWD_SOURCES = {
    "sales/dwd_vbak": "sap_erp/vbak",
    "sales/dwd_vbap": "sap_erp/vbap",
    "sales/dwd_kna1": "sap_erp/kna1",
    "production/dwd_tags": "pi_system/tags",
    "coal_quality/dwd_samples": "lims/samples",
    "finance/dwd_doc_flow": "oa/doc_flow",
}


# --- fixed values: partition columns of the landed tables ---
ODS_PARTITIONS = {
    "sap_erp/vbak": ["year"],
    "sap_erp/vbap": ["year"],
    "pi_system/tags": ["year", "month"],
    "lims/samples": ["year"],
    "oa/doc_flow": ["year"],
}


def table_path(root: str, layer: str, key: str) -> str:
    """The one place that knows where a table lives."""
    return f"{root}/{layer}/{key}"


def ingest_ods(root: str, raw: dict[str, DataFrame]) -> None:
    """Land every raw table as it is, all of its files, partitioned for pruning where it has the columns."""
    for key, df in raw.items():
        columns = [c for c in ODS_PARTITIONS.get(key, []) if c in df.columns]
        lake.commit(df, table_path(root, "ods", key), partition_by=columns)


def build_dwd(spark: SparkSession, root: str, order_by: dict[str, list]) -> None:
    """Clean each landed table; a source that is absent is skipped."""
    for key, source in DWD_SOURCES.items():
        source_path = table_path(root, "ods", source)
        if lake.latest_version(spark, source_path) < 0:
            continue
        name = source.split("/")[1]
        cleaned = clean(lake.read_version(spark, source_path), name, order_by.get(name))
        # The place in the raw file only says which copy was first; it is no data of the clean table.
        lake.commit(cleaned.drop(*POSITION), table_path(root, "dwd", key))


def build_dwa(spark: SparkSession, root: str) -> None:
    def dwd(key: str) -> DataFrame:
        return lake.read_version(spark, table_path(root, "dwd", key))

    lake.commit(marts.sales_daily(dwd("sales/dwd_vbak")), table_path(root, "dwa", "sales/dwa_sales_daily"))
    raw_tags = lake.read_version(spark, table_path(root, "ods", "pi_system/tags"))
    lake.commit(marts.tag_alarm(raw_tags), table_path(root, "dwa", "production/dwa_tag_alarm"))
    lake.commit(marts.coal_quality(dwd("coal_quality/dwd_samples")), table_path(root, "dwa", "coal_quality/dwa_coal_quality"))


def run(spark: SparkSession, root: str, raw: dict[str, DataFrame], order_by: dict[str, list], layer: str = "all") -> DataFrame:
    """Run one layer or all of them and report rows before and after cleaning, per table."""
    if layer in ("ods", "all"):
        ingest_ods(root, raw or {})
    if layer in ("dwd", "all"):
        build_dwd(spark, root, order_by)
    if layer in ("dwa", "all"):
        build_dwa(spark, root)
    return stats(spark, root)


def stats(spark: SparkSession, root: str) -> DataFrame:
    """before / after / dropped per cleaned table, counted from the committed files."""
    report = None
    for key, source in DWD_SOURCES.items():
        for side, layer, name in (("before", "ods", source), ("after", "dwd", key)):
            path = table_path(root, layer, name)
            if lake.latest_version(spark, path) < 0:
                continue
            counted = lake.read_version(spark, path).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(key).alias("table_name"), F.lit(side).alias("side"), "n"
            )
            report = counted if report is None else report.unionByName(counted)
    wide = report.groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "before", F.col("n"))).alias("before"),
        F.sum(F.when(F.col("side") == "after", F.col("n"))).alias("after"),
    )
    return wide.withColumn("dropped", F.col("before") - F.col("after"))
