"""Catalog statistics read from the files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.constants import SYSTEM_ASSETS
from lodeworks.sources.literal import literal_table


def partitions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows and size per file. Only file metadata is read: the scan needs no data column.

    The table is named by its path: a directory of part files is one table, whatever its files are
    called. Every partition part counts (``year/month``), in directory or in file names.
    """
    result = None
    for path in paths:
        files = spark.read.option("recursiveFileLookup", "true").parquet(path).select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
        )
        result = files if result is None else result.unionByName(files)
    counted = result.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("row_count"))
    table_path = F.regexp_replace("file_path", r"((/[^/=]+=[^/]+)+/[^/]+|/part-[^/]*)$", "")
    parts = lambda group: F.array_join(F.regexp_extract_all("file_path", F.lit(r"(year|month)=([^/_.]+)"), F.lit(group)), "/")
    return counted.select(
        F.regexp_extract(table_path, r"([^/]+?)(?:_(?:year|month)=.*)?(?:\.parquet)?$", 1).alias("table_name"),
        parts(1).alias("partition_field"),
        parts(2).alias("partition_value"),
        "file_path",
        "row_count",
        F.round(F.col("file_size") / F.lit(1024.0 * 1024.0), 3).alias("size_mb"),
    )


def profile(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Row count and columns with types; the schema comes from the footer, the count from metadata."""
    df = spark.read.parquet(path)
    fields = F.array(
        *[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type")) for f in df.schema]
    )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(fields)
    )


def asset_reference(spark: SparkSession) -> DataFrame:
    rows = [
        (system, table, label, owner, level)
        for system, (owner, level, tables) in SYSTEM_ASSETS.items()
        for table, label in tables.items()
    ]
    return literal_table(
        spark, rows, "system string, table_name string, label string, owner string, security_level string"
    )


def assets(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Asset list: every declared table, with rows, size and partition field where data exists, and a
    connection status. ``counts``: system, table_name, row_count, size_mb, partition_field."""
    return asset_reference(spark).join(counts, ["system", "table_name"], "left").select(
        "system",
        "table_name",
        "label",
        "owner",
        "security_level",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce("size_mb", F.lit(0.0)).alias("size_mb"),
        F.coalesce("partition_field", F.lit("")).alias("partition_field"),
        F.when(F.col("row_count").isNull(), "unknown")
        .when(F.col("row_count") > 0, "connected")
        .otherwise("disconnected")
        .alias("status"),
    )


def table_sizes(files: DataFrame) -> DataFrame:
    """Rows, size and partition field per table, out of ``partitions``."""
    return files.groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("size_mb").alias("size_mb"), F.max("partition_field").alias("partition_field")
    )


def system_status(listed: DataFrame) -> DataFrame:
    """One row per system out of ``assets``: tables, rows, size, and whether anything is connected."""
    return listed.groupBy("system").agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("status") == "connected").alias("connected_tables"),
        F.sum("row_count").alias("row_count"),
        F.sum("size_mb").alias("size_mb"),
        F.when(F.bool_or(F.col("status") == "connected"), "connected")
        .when(F.bool_or(F.col("status") == "disconnected"), "disconnected")
        .otherwise("unknown")
        .alias("status"),
    )


def classify(spark: SparkSession, used: DataFrame) -> DataFrame:
    """Security level of the tables in use."""
    levels = asset_reference(spark).select("system", "table_name", "security_level")
    return used.join(F.broadcast(levels), ["system", "table_name"], "left")


def glossary_terms(glossary: DataFrame) -> DataFrame:
    """``table_name, column_name, cn_name, business_terms array`` -> one row per business term."""
    return glossary.select("table_name", "column_name", "cn_name", F.explode_outer("business_terms").alias("term"))


def glossary_codes(glossary: DataFrame) -> DataFrame:
    """``value_mappings map`` -> one row per code."""
    return glossary.select("table_name", "column_name", F.explode("value_mappings").alias("code", "label"))


def decode(df: DataFrame, glossary: DataFrame, table: str, column: str, alias: str) -> DataFrame:
    """Replace codes by their labels; a code without a label gives NULL."""
    codes = glossary_codes(glossary.where((F.col("table_name") == table) & (F.col("column_name") == column)))
    return df.join(codes.select(F.col("code").alias(column), F.col("label").alias(alias)), column, "left")
