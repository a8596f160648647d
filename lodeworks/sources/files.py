"""Reading raw files: partition values in file names, yearly files, daily increments, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "no value" in files written by dataframe tools; Spark would rank it above all numbers."""
    floats = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


# Where a raw row is stored: the order that "keep the first" refers to.
POSITION = ["_file", "_row"]


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All files of a raw table with partition values, positions, and NaN turned into NULL."""
    raw = spark.read.option("mergeSchema", "true").parquet(path)
    fields = [f for f in ("year", "month") if f not in raw.columns]
    name = F.col("_metadata.file_path")
    placed = raw.select(
        "*",
        name.alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
        *[F.regexp_extract(name, rf"{f}=(\d+)", 1).try_cast("int").alias(f) for f in fields],
    )
    return nan_to_null(placed)


def with_name_partitions(df: DataFrame, fields: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Partition columns out of the file path (``vbak_year=2022.parquet``); a column the data already
    has stays as it is, a field the path lacks gives NULL."""
    name = F.col("_metadata.file_path")
    new = {
        f: F.regexp_extract(name, rf"{f}=(\d+)", 1).try_cast("int") for f in fields if f not in df.columns
    }
    return df.select("*", *[c.alias(f) for f, c in new.items()])


def concat_years(frames: list[DataFrame]) -> DataFrame:
    """Yearly files as one relation; a column that a year lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def increment_path(base: str, date: str, system: str, table: str) -> str:
    return f"{base}/{date}/{system}/{table}.parquet"


def read_increment(spark: SparkSession, base: str, date: str, system: str, table: str) -> DataFrame:
    return spark.read.parquet(increment_path(base, date, system, table))


def write_increment(df: DataFrame, base: str, date: str, system: str, table: str) -> str:
    path = increment_path(base, date, system, table)
    df.write.mode("overwrite").parquet(path)
    return path


def since(df: DataFrame, column: str, high_water) -> DataFrame:
    """Rows newer than the last sync; the comparison is pushed down to the file scan."""
    return df.where(F.col(column) > high_water)


def with_audit(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns({"etl_time": F.current_timestamp(), "source_system": F.lit(source_system)})


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
